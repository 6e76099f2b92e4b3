"""Connected components of links: rounds only while there is a link that is not to the smallest node."""

import random

import pytest

from souk.llm import components as C
from souk.llm.common import Stage


def _written(stage, monkeypatch):
    names, write = [], stage.write
    monkeypatch.setattr(stage, "write", lambda df, name, *a: (names.append(name), write(df, name, *a))[1])
    return names


def test_stars_need_no_round(spark, monkeypatch):
    stage = Stage(spark, "stars")
    names = _written(stage, monkeypatch)
    links = spark.createDataFrame([(1, k) for k in range(2, 60)] + [(7, 1), (100, 101), (5, 5)], "a long, b long")
    got = {tuple(x) for x in C.components(links, stage).collect()}
    assert got == {(k, 1) for k in range(1, 60)} | {(100, 100), (101, 100)}
    assert names == ["links"]
    assert C.components(links.limit(0), stage).count() == 0 and names == ["links"] * 2


@pytest.mark.parametrize("sent,minima", [(C.BROADCAST_LINKS, C.WRITE_MINIMA), (0, C.WRITE_MINIMA), (0, 1)])
def test_like_a_search(spark, monkeypatch, sent, minima):
    monkeypatch.setattr(C, "BROADCAST_LINKS", sent)
    monkeypatch.setattr(C, "WRITE_MINIMA", minima)
    r = random.Random(5)
    path = r.sample(range(1000, 1040), 40)
    links = [(r.randrange(150), r.randrange(150)) for _ in range(90)] + list(zip(path, path[1:])) + [(2000, k) for k in range(1500, 1560)]
    near = {}
    for a, b in links:
        if a != b:
            near.setdefault(a, set()).add(b), near.setdefault(b, set()).add(a)
    want = {}
    for node in sorted(near):
        todo = [node] if node not in want else []
        while todo:
            x = todo.pop()
            if x not in want:
                want[x] = node
                todo += near[x]
    got = [tuple(x) for x in C.components(spark.createDataFrame(links, "a long, b long"), Stage(spark, "search")).collect()]
    assert sorted(got) == sorted(want.items())

"""Byte-level BPE: a SentencePiece BPE model written straight from a rank vocabulary.

* Every byte has a printable stand-in character; a vocabulary entry becomes the
  string of the stand-ins of its bytes, a piece with score ``-rank``.  The
  normaliser is the identity, no dummy prefix, no white-space escaping, so the
  model merges exactly the pair with the lowest rank first, as rank-based BPE does.
* Text is cut into pre-tokens by the tokenizer's pattern; each pre-token is
  encoded on its own (a pre-token that is itself a vocabulary entry is that id).
* A space between two other characters that are no white space always begins a
  pre-token.  Texts whose spaces all stand alone are cut there first, and the ids of
  a stretch between spaces are remembered; other texts go through the
  pattern as a whole.
* Decoding maps every id back to its bytes.

The work is per row in Arrow batches: no shuffle, memory bounded by one batch,
a lost executor repeats only its own tasks.

Defined results: a null or empty text gives no ids, and decodes to no bytes;
repeated rows and null ids of rows are kept row by row; other columns are not
read.  An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE_TOKENS = 400_000  # pre-tokens, and as many stretches between spaces, that a worker remembers
_ENCODERS: dict = {}


def byte_alphabet() -> list[str]:
    """Stand-in character of each byte: itself where printable, else the next one from U+0100."""
    printable = {b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b}
    shifted = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(shifted)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one ``base64(token) rank`` per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """Serialised SentencePiece model: piece i is the token of rank i, the unknown piece comes last."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    alphabet = byte_alphabet()
    by_rank = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must run from 0 without gaps")
    model = pb.ModelProto()
    for rank, token in enumerate(by_rank):
        model.pieces.add(piece="".join(alphabet[b] for b in token), score=-float(rank), type=pb.ModelProto.SentencePiece.NORMAL)
    model.pieces.add(piece="<unk>", score=-float(len(by_rank)), type=pb.ModelProto.SentencePiece.UNKNOWN)
    t = model.trainer_spec
    t.model_type, t.vocab_size, t.unk_id = pb.TrainerSpec.BPE, len(model.pieces), len(by_rank)
    t.bos_id = t.eos_id = t.pad_id = -1
    n = model.normalizer_spec
    n.name, n.precompiled_charsmap = "identity", b""
    n.add_dummy_prefix = n.remove_extra_whitespaces = n.escape_whitespaces = False
    return model.SerializeToString()


@lru_cache(maxsize=4)
def older_unicode_pattern(pattern: str) -> tuple[str, int]:
    """The pattern with letter and number classes as the tiktoken engine has them, and the
    first code point from which it can differ from ``pattern`` under the regex module.

    The two engines carry different Unicode versions.  Code points whose class
    is in doubt (the regex module and ``unicodedata`` disagree) are tried
    in tiktoken itself with a probe vocabulary in which a letter, a digit or a
    symbol merges with the first byte of what follows in the same pre-token.
    """
    import regex
    import tiktoken

    everything = "".join(map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x110000)]))
    kinds = {k: set(regex.findall(p, everything)) for k, p in (("L", r"\p{L}"), ("N", r"\p{N}"), ("S", r"\s"))}
    known = lambda c: "S" if c in kinds["S"] else unicodedata.category(c)[0]
    doubtful = [c for k in "LN" for c in kinds[k] if known(c) != k]
    doubtful += [c for c in everything if c not in kinds["L"] and c not in kinds["N"] and known(c) in "LN"]
    probes = [bytes([b]) for b in range(256)] + [bytes([p, b]) for p in b"a1!" for b in range(128, 256)]
    engine = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(probes)}, special_tokens={})
    joined = lambda p, c: engine.encode_ordinary(p + c)[0] >= 256
    wrong = {k: [c for c in doubtful if c in kinds[k] and not joined(p, c)] for k, p in (("L", "a"), ("N", "1"))}
    missing = {k: [c for c in doubtful if c not in kinds[k] and joined(p, c)] for k, p in (("L", "a"), ("N", "1"))}
    changed = [ord(c) for part in (wrong, missing) for cs in part.values() for c in cs]
    if not changed:
        return pattern, sys.maxunicode + 1

    def members(k: str) -> str:
        out = rf"\p{{{k}}}"
        if wrong[k]:
            out = f"[{out}--[{''.join(map(regex.escape, wrong[k]))}]]"
        return f"[{out}||[{''.join(map(regex.escape, missing[k]))}]]" if missing[k] else out

    exact = pattern
    for k in "LN":
        exact = exact.replace(rf"\p{{{k}}}", members(k))
    return "(?V1)" + exact, min(changed)


class Encoder:
    """Encodes texts in one worker process; built once per process and model."""

    def __init__(self, model: bytes, ranks: dict[bytes, int], pattern: str, exact: tuple[str, int]):
        import regex
        import sentencepiece

        self.fast = regex.compile(pattern).findall
        self.exact = regex.compile(exact[0]).findall
        self.exact_from = chr(exact[1]) if exact[1] <= sys.maxunicode else None
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.ranks = ranks
        self.to_alphabet = dict(enumerate(byte_alphabet()))
        self.known: dict[str, bytes] = {}
        self.stretches: dict[str, bytes] = {}  # by the stretch without the space that it begins with
        spaces = [c for c in map(chr, range(0x3001)) if regex.match(r"\s", c) or c.isspace()]
        self.other_space = regex.compile("[" + "".join(map(regex.escape, set(spaces) - {" ", "\n"})) + "]").search

    def _learn(self, tokens: list[str]) -> None:
        if len(self.known) > CACHE_TOKENS:
            self.known.clear()
        fresh = list({t for t in tokens if t not in self.known})
        rest = []
        for t in fresh:
            rank = self.ranks.get(t.encode())
            if rank is None:
                rest.append(t)
            else:
                self.known[t] = rank.to_bytes(4, "little")
        if rest:
            mapped = [t.encode().decode("latin-1").translate(self.to_alphabet) for t in rest]
            for t, ids in zip(rest, self.pieces.encode(mapped, out_type=int, num_threads=1)):
                self.known[t] = np.asarray(ids, "<u4").tobytes()

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        cut = self.exact if self.exact_from and not text.isascii() and max(text) >= self.exact_from else self.fast
        if "  " in text or " \n" in text or "\n " in text or self.other_space(text):
            return self._pieces(cut(text))
        first, *rest = text.split(" ")
        try:
            ids = b"".join(map(self.stretches.__getitem__, rest))
        except KeyError:
            if len(self.stretches) > CACHE_TOKENS:
                self.stretches.clear()
            fresh = list({x for x in rest if x not in self.stretches})
            tokens = [cut(" " + x) for x in fresh]
            self._learn([t for ts in tokens for t in ts])
            self.stretches.update((x, b"".join(map(self.known.__getitem__, ts))) for x, ts in zip(fresh, tokens))
            ids = b"".join(map(self.stretches.__getitem__, rest))
        return self._pieces(cut(first)) + ids

    def _pieces(self, tokens: list[str]) -> bytes:
        try:
            return b"".join(map(self.known.__getitem__, tokens))
        except KeyError:
            self._learn(tokens)
            return b"".join(map(self.known.__getitem__, tokens))


def encode(docs: DataFrame, vocab_path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``ids`` (little-endian unsigned 32-bit, binary) and ``n_tokens``.

    ``vocab_path`` is read on the driver; its model (about 1 MB, fixed by the
    vocabulary and not by the data) is broadcast.
    """
    sc = docs.sparkSession.sparkContext
    ranks = read_ranks(vocab_path)
    shared = sc.broadcast((model_bytes(ranks), ranks, pattern, older_unicode_pattern(pattern)))
    chosen = docs.select(*keep, F.col(text).alias("__text"))
    schema = docs.select(*keep).schema.add("ids", "binary", False).add("n_tokens", "long", False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (hash(shared.value[0]), shared.value[2])
        if key not in _ENCODERS:
            _ENCODERS[key] = Encoder(*shared.value)
        ids = _ENCODERS[key].ids
        for b in batches:
            for at in range(0, b.num_rows, 256):  # small slices: memory follows a few texts, not the batch
                part = b.slice(at, 256)
                out = [ids(t.as_py()) for t in part.column(part.num_columns - 1)]
                n = pa.array([len(x) // 4 for x in out], pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(out, pa.binary()), n], names=[*keep, "ids", "n_tokens"])

    return chosen.mapInArrow(run, schema)


def decode(encoded: DataFrame, vocab_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds ``out`` (binary): the bytes of the ids.  Null ids decode to no bytes."""
    ranks = read_ranks(vocab_path)
    tokens = encoded.sparkSession.sparkContext.broadcast(sorted(ranks, key=ranks.get))
    names = encoded.columns
    at_ids = names.index(ids)
    schema = encoded.select("*").schema.add(out, "binary", False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = tokens.value.__getitem__
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                texts = [b"".join(map(token, np.frombuffer(x.as_py() or b"", "<u4").tolist())) for x in part.column(at_ids)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], names=[*names, out])

    return encoded.mapInArrow(run, schema)


def encode_decode_digests(docs: DataFrame, vocab_path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id, n_tokens and the digests of its ids and of the decoded bytes."""
    both = decode(encode(docs, vocab_path, pattern), vocab_path)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))

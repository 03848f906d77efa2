"""Token ids of texts by a public byte-level BPE vocabulary, exact to the merges.

A text is cut by the vocabulary's pattern; of each piece the encoding is found by dynamic programming over prefixes. A
prefix of a piece has exactly one last token: the token that ends the prefix, whose start is the end of a prefix encoded
before, and which is compatible with that prefix's last token (undoing both tokens' merges never lets a merge across the
border come first). An automaton over all tokens gives the candidates at each position; the last tokens are stored and
followed back from the end. Time is linear in the text, whatever it holds, unlike merging pair by pair.

Defined results: null and empty texts have an empty list; names of special tokens in a text are ordinary text.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Fixed value: the pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KEPT_PIECES, KEPT_LENGTH, KEPT_PAIRS = 300_000, 48, 2_000_000


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Tables of one vocabulary and the encoding of texts."""

    def __init__(self, vocabulary: str) -> None:
        import ahocorasick
        import regex

        model = json.loads(vocabulary)["model"]
        letters = byte_letters()
        plain = {token: "".join(chr(letters[c]) for c in token) for token in model["vocab"]}
        ids = model["vocab"]
        self.rank = {}  # token -> when it is merged; single bytes never are
        self.parts = {}
        self.merged = {}
        for when, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            whole = ids[left + right]
            self.merged[ids[left], ids[right]] = when
            self.rank[whole], self.parts[whole] = when, (ids[left], ids[right])
        self.automaton = ahocorasick.Automaton()
        for token, i in ids.items():
            if i in self.parts or len(plain[token]) == 1:
                self.automaton.add_word(plain[token], (i, len(plain[token])))
        self.automaton.make_automaton()
        self.pieces = regex.compile(PATTERN).findall
        self.pairs: dict[tuple[int, int], bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart when the bytes of both are merged in order."""
        if (left, right) in self.pairs:
            return self.pairs[left, right]
        rank, parts, merged = self.rank, self.parts, self.merged
        a, b, latest, apart = left, right, len(merged), True
        while True:
            if merged.get((a, b), latest) < latest:
                apart = False
                break
            # undo the later of the two merges that made the tokens at the border; equal ranks: the right one is made later
            ra, rb = rank.get(a, -1), rank.get(b, -1)
            if ra < 0 and rb < 0:
                break
            if ra > rb:
                a, latest = parts[a][1], ra
            else:
                b, latest = parts[b][0], rb + 1
        if len(self.pairs) >= KEPT_PAIRS:
            self.pairs.clear()
        self.pairs[left, right] = apart
        return apart

    def _piece(self, piece: str) -> tuple[int, ...]:
        last, starts = [-1] * (len(piece) + 1), [0] * (len(piece) + 1)
        pairs, compatible = self.pairs, self.compatible
        for end, (token, length) in self.automaton.iter(piece):
            end += 1
            if last[end] >= 0:
                continue
            start = end - length
            if start:
                before = last[start]
                if before < 0:
                    continue
                apart = pairs.get((before, token))
                if not (compatible(before, token) if apart is None else apart):
                    continue
            last[end], starts[end] = token, start
        out, at = [], len(piece)
        while at:
            out.append(last[at])
            at = starts[at]
        return tuple(reversed(out))

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        if not text:
            return out
        known = self.known
        for piece in self.pieces(text):
            ids = known.get(piece)
            if ids is None:
                ids = self._piece(piece.encode().decode("latin-1"))
                if len(piece) <= KEPT_LENGTH:
                    if len(known) >= KEPT_PIECES:
                        known.clear()
                    known[piece] = ids
            out += ids
        return out


@lru_cache(maxsize=2)
def _encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


def _shared(spark: SparkSession, path: str):
    """The vocabulary file, read once on the driver (a few MB, whatever the corpus) and sent to the executors."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def token_ids(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids) of every document."""
    import pyarrow as pa

    shared = _shared(documents.sparkSession, vocabulary)
    out = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(shared.value).encode
        for part in batches:
            for at in range(0, len(part), 1000):
                some = part.slice(at, 1000)
                ids = pa.array([encode(t) for t in some.column(1).to_pylist()], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([some.column(0), ids], schema=out)

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id bigint, ids array<int>")


def token_counts(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, n_tokens) of every document."""
    import pyarrow as pa

    shared = _shared(documents.sparkSession, vocabulary)
    out = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(shared.value).encode
        for part in batches:
            counts = pa.array([len(encode(t)) for t in part.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), counts], schema=out)

    return documents.select("doc_id", "source", "text").mapInArrow(run, "doc_id bigint, source string, n_tokens bigint")

"""Packing documents into training sequences by order-preserving dynamic programming.

The tokens of a partition's documents, each ended by an end id, form one stream in the order of its rows. Cuts are
chosen at document or sentence ends so that the sum of padding, cut penalties and a small cost per sequence is least;
where sentences are longer than a window, cuts inside them are allowed too. With f(i) the least cost up to boundary i,

    f(i) = penalty(i) + per_sequence + min over boundaries j, i - window <= j < i, of f(j) + padding(i - j)

and padding(u) = 0 where u is a power of two, else window - u. As f(j) + window - (i - j) is f(j) + j less a constant of
i, a monotone queue keeps its minimum over the sliding range; lengths that are powers of two are looked up apart.

Each task packs its own rows, in blocks of a bounded number of tokens, so nothing is shuffled, memory is bounded and a
task that is run again on the same rows gives the same pieces. A sequence's id holds its partition in the upper bits.

Defined cases: null text is empty and gives one end id; repeated and null ids are documents of their own, row by row;
strings of special tokens in a text are read as the tokenizer reads them by default; texts on whose long runs of one kind
of sign the faster coder gives up are coded by the library itself; an empty table gives no rows; other columns of docs are
left out, and where id_col is the name of a result column, that column's name gets a trailing underscore.
"""

from __future__ import annotations

import json
import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import free, table

WINDOW, END_ID, VOCABULARY = 2048, 1, "byte_bpe_50k.json"
#: Costs, in tokens of padding: a cut at a sentence's end, one inside a sentence, each sequence.
SENTENCE_CUT, HARD_CUT, PER_SEQUENCE = 4, 24, 2
#: Tokens packed together.
BLOCK = 1 << 20
#: The tokenizer's pattern; a fixed value of byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_letters() -> dict[str, int]:
    """The letter of each byte in a byte-level vocabulary: printable bytes are their own, others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(own)))}


class Coder:
    """Ids of texts under a byte-level BPE of the tokenizers library.

    The vocabulary of the library's own file, whose ids rise with the order of the merges, is given as ranks to a coder
    that works much faster on long texts; the ids are those of the library (tests compare the two).
    """

    def __init__(self, path: str):
        import tiktoken

        self.path, self.library = path, None
        with open(path, encoding="utf-8") as f:
            kept = json.load(f)
        special = {t["content"]: t["id"] for t in kept["added_tokens"]}
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in piece): i for piece, i in kept["model"]["vocab"].items() if piece not in special}
        self.special = set(special)
        self.coder = tiktoken.Encoding("weftline", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.sentence_end = np.zeros(max(self.coder.n_vocab, 2) + 1, bool)
        for piece, i in ranks.items():
            if piece[-1:] in (b".", b"!", b"?") or b"\n" in piece:
                self.sentence_end[i] = True

    def __call__(self, text: str) -> np.ndarray:
        try:
            return self.coder.encode_to_numpy(text, allowed_special=self.special)
        except ValueError:  # its pattern engine's stack is bounded
            return self.by_library(text)

    def by_library(self, text: str) -> np.ndarray:
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)


@lru_cache(1)
def coder_of(path: str) -> Coder:
    """A worker's coder, kept from task to task."""
    return Coder(path)


def best_cuts(boundary: np.ndarray, penalty: np.ndarray, window: int, per_sequence: float = PER_SEQUENCE) -> list[int]:
    """Indices of the boundaries (ascending positions from 0, none further than window apart) where the cheapest cutting
    of the stream cuts; the first and the last are among them."""
    n = len(boundary)
    powers = [(1 << k) for k in range(window.bit_length()) if 1 << k <= window]
    exact: list[list[int]] = [[] for _ in range(n)]
    for p in powers:
        at = np.searchsorted(boundary, boundary - p)
        for i in np.flatnonzero((at < n) & (boundary[np.minimum(at, n - 1)] == boundary - p)).tolist():
            exact[i].append(int(at[i]))
    where, cost = boundary.tolist(), (penalty + per_sequence).tolist()
    least, back = [0.0] * n, [0] * n
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])  # (f(j) + j's position, j), values rising
    for i in range(1, n):
        x = where[i]
        low = x - window
        while where[queue[0][1]] < low:
            queue.popleft()
        v, b = queue[0]
        v += window - x
        for j in exact[i]:
            if least[j] < v:
                v, b = least[j], j
        v += cost[i]
        least[i], back[i] = v, b
        v += x
        while queue and queue[-1][0] >= v:
            queue.pop()
        queue.append((v, i))
    path = [n - 1]
    while path[-1]:
        path.append(back[path[-1]])
    return path[::-1]


def boundaries(ids: np.ndarray, doc_ends: np.ndarray, sentence_end: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions where the stream may be cut, and the penalty of each."""
    kind = np.full(len(ids) + 1, HARD_CUT, np.float64)
    ends = np.flatnonzero(sentence_end[np.minimum(ids, len(sentence_end) - 1)]) + 1
    kind[ends] = SENTENCE_CUT
    kind[doc_ends] = 0
    kind[0] = kind[-1] = 0
    at = np.flatnonzero(kind < HARD_CUT)
    gaps = np.flatnonzero(np.diff(at) > window)
    if len(gaps):
        more = [np.arange(at[g] + window, at[g + 1], window) for g in gaps]
        at = np.unique(np.concatenate([at, *more]))
    return at, kind[at]


def pack(ids: np.ndarray, lengths: np.ndarray, sentence_end: np.ndarray, window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of the pieces of documents with these lengths in the stream ids."""
    ends = np.cumsum(lengths)
    at, penalty = boundaries(ids, ends, sentence_end, window)
    cuts = at[best_cuts(at, penalty, window)]
    edges = np.unique(np.concatenate([cuts, ends]))
    a, b = edges[:-1], edges[1:]
    doc = np.searchsorted(ends, a, side="right")
    sequence = np.searchsorted(cuts, a, side="right") - 1
    return list(zip(doc.tolist(), (a - (ends - lengths)[doc]).tolist(), (b - a).tolist(), sequence.tolist(), (a - cuts[sequence]).tolist(), strict=True))


def packed(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per piece: id_col, start, length, ids (if with_ids), ids_crc32, doc_tokens, sequence_id, offset."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    columns = [id_col, *(free(n, [id_col]) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids))]
    schema = ", ".join(f"`{n}` {k}" for n, k in zip(columns, [kind, *["long"] * 6, "array<int>"], strict=False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, context = coder_of(tokenizer_path), TaskContext.get()
        end = np.array([end_id], np.uint32)
        sequence = (context.partitionId() if context else 0) << 36
        names: list = []
        held: list[np.ndarray] = []
        lengths: list[int] = []
        waiting = 0

        def out() -> pa.RecordBatch:
            nonlocal sequence, waiting
            ids, sizes = np.concatenate(held), np.array(lengths, np.int64)
            rows = pack(ids, sizes, coder.sentence_end, window)
            first = np.cumsum(sizes) - sizes
            doc, start, length, number, offset = (np.array(c, np.int64) for c in zip(*rows, strict=True))
            raw = ids.astype("<u4")
            begin = first[doc] + start
            crcs = [zlib.crc32(raw[a:b]) for a, b in zip(begin.tolist(), (begin + length).tolist(), strict=True)]
            arrays = [pa.array(names, kinds).take(pa.array(doc)), *map(pa.array, (start, length, np.array(crcs, np.int64), sizes[doc], number + sequence, offset))]
            if with_ids:
                arrays.append(pa.ListArray.from_arrays(pa.array(np.append(begin, len(ids)).astype(np.int32)), pa.array(ids.astype(np.int32))))
            sequence += int(number[-1]) + 1
            names.clear(), held.clear(), lengths.clear()
            waiting = 0
            return pa.RecordBatch.from_arrays(arrays, columns)

        kinds = None
        for batch in batches:
            kinds = batch.schema.field(0).type
            for name, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = coder(text.as_py())
                names.append(name.as_py())
                held += [ids, end]
                lengths.append(len(ids) + 1)
                waiting += len(ids) + 1
                if waiting >= BLOCK:
                    yield out()
        if names:
            yield out()

    return rows.mapInArrow(run, schema)


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), tokenizer_file(), with_ids=False)


QUERIES = {"op3_monotone_queue_packing": op3}

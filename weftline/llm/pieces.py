"""SentencePiece encoding and decoding as a relational lattice.

A text is normalised as the model says (a space in front, spaces as U+2581) and split into words that no piece crosses.
Each distinct word's lattice is made once: its substrings of at most the longest piece's length are exploded and
equi-joined with the piece table (broadcast; as many rows as the vocabulary), edges are grouped by word, and a Spark
higher-order aggregate folds them to ids. Two folds are given. For unigram models it is Viterbi: the best score up to
each position (viterbi_words()). For BPE models, whose scores are merge ranks, the path of the best sum isn't what the
model means; there the fold merges neighbouring edges in the order of their ranks, which gives the library's ids.
Characters outside the vocabulary become their UTF-8 bytes' pieces.

Ids return to the documents in two ways. The words that are most frequent in a sample of SAMPLE_DOCS documents, FREQUENT
of at most SHORT characters each, go through the lattice first and are broadcast: that bounds the table's size, and leaves
no frequent word out; which words are in it changes no result. A pass over the documents then gives runs of such words. All
other words are shuffled once, with their places; their lattices are folded where they land and joined to the places there.
The result has a row for each run and each other word: `position` is the place of its first word in the document, and rows
in the order of `position` make the document (by_document() gathers them). `text_key` tells the texts of one id apart. Words
of more than LONGEST characters, whose positions don't fit the bits of a long, are folded by the same merges over a heap.

Defined cases: null and empty text is one row without ids; repeated rows are encoded alike, each for itself, and gathered
and decoded as often as they came; null ids are an id of their own; texts are cut into parts of SEGMENT characters
between words, so a long one takes no more memory than a short one; an empty table gives no rows; other columns of docs are
left out, and where id_col is the name of a result column, that column's name gets a trailing underscore. Decoding takes
unknown ids as the library does, and control ids as nothing; bytes that aren't UTF-8 become U+FFFD.
"""

from __future__ import annotations

import heapq
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import batched, free, table, width

MODEL, LONGEST, SPACE = "piece_bpe_32k.model", 60, "▁"
#: Words that are broadcast, characters of each at most, and documents from which they are taken.
FREQUENT, SHORT, SAMPLE_DOCS = 200_000, 24, 8_000
#: Characters of a text that are split at once, and bytes of a batch.
SEGMENT, BATCH = 1 << 20, 1 << 20
#: What a unigram model charges for an unknown character below its worst piece; a fixed value.
UNKNOWN_PENALTY = 10.0

_WORD = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
_BETWEEN = re.compile(f"(?<=[^{SPACE}]){SPACE}")


def model_file() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def piece_rows(path: str) -> list[tuple[str, int, float]]:
    """(piece, id, score) of the pieces that match text."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = [(m.id_to_piece(i), i, m.get_score(i)) for i in range(m.get_piece_size()) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]
    for piece, _, _ in rows:
        if SPACE in piece.lstrip(SPACE) or "\n" in piece and len(piece) > 1:
            raise ValueError(f"a piece crosses words: {piece!r}")
    return rows


def ranked(rows: list[tuple[str, int, float]]) -> list[tuple[str, int, float, int]]:
    """(piece, id, score, rank): the best score first."""
    order = sorted(range(len(rows)), key=lambda k: (-rows[k][2], rows[k][1]))
    place = {k: r for r, k in enumerate(order)}
    return [(*row, place[k]) for k, row in enumerate(rows)]


def segments(text: str, most: int = SEGMENT) -> Iterator[str]:
    """The text, U+2581 for spaces and in front, in parts of about so many characters that end between words."""
    if not text:
        return
    text = SPACE + text.replace(" ", SPACE)
    at = 0
    while cut := _BETWEEN.search(text, at + most):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def words(text: str | None) -> list[str]:
    return [w for part in segments(text or "") for w in _WORD.findall(part)]


def edges(distinct: DataFrame, pieces: DataFrame, longest_piece: int, edge: Column, shortest: int = 1) -> DataFrame:
    """(at, word, edges, odd): the lattice of each word; edge is made of rank, first, end, id and score.

    Edges of fewer than `shortest` characters are left out (a BPE fold starts from all single characters anyway). Words
    are numbered, so that grouping a word's edges, which follow each other, sorts numbers that are in order already.
    """
    n = F.length("word")
    numbered = distinct.select("word", F.monotonically_increasing_id().alias("at"))
    starts = numbered.select("at", "word", F.explode(F.sequence(F.lit(0), n - 1)).alias("first"))
    room = F.least(F.lit(longest_piece), n - F.col("first"))
    sizes = F.when(room >= shortest, F.sequence(F.lit(shortest), room)).otherwise(F.when(F.col("first") == 0, F.array(F.lit(1))))
    spans = starts.select("at", "word", "first", F.explode(sizes).alias("size"))
    cut_out = spans.select("at", "word", "first", (F.col("first") + F.col("size")).alias("end"), F.col("word").substr(F.col("first") + 1, F.col("size")).alias("piece"))
    # A left join keeps the words of which no substring is a piece.
    pieces = pieces.where(F.length("piece") >= shortest)
    met = cut_out.join(F.broadcast(pieces), "piece", "left").where(f"id IS NOT NULL OR first = 0 AND (end = {shortest} OR end = 1)")
    return met.groupBy("at", "word").agg(F.collect_list(F.when(F.col("id").isNotNull(), edge)).alias("edges"), F.coalesce(F.bool_or("odd"), F.lit(False)).alias("odd"))


#: An edge of a BPE lattice in a long: rank, first and end; and one for Viterbi.
PACKED = "shiftleft(cast(rank AS BIGINT), 12) | shiftleft(cast(first AS BIGINT), 6) | cast(end AS BIGINT)"
SCORED = "struct(rank, first, end, id, score)"


def out_of_order(rows: list[tuple[str, int, float, int]]) -> set[str]:
    """Pieces that merging their own characters in one pass over ranks doesn't give.

    Inside a segment all earlier merges are those of the segment's text alone. So where every piece of a word comes out
    of one pass in the order of ranks, each edge is met when it may be merged, and one pass gives what taking the best
    merge again and again does.
    """
    rank = {r[0]: r[3] for r in rows}
    odd = set()
    for piece in rank:
        n = len(piece)
        if n < 2:
            continue
        found = sorted((rank[piece[i:j]], i, j) for i in range(n) for j in range(i + 2, n + 1) if piece[i:j] in rank)
        starts = set(range(n + 1))
        for _, i, j in found:
            inside = [k for k in range(i + 1, j) if k in starts]
            if i in starts and j in starts and len(inside) == 1:
                starts.remove(inside[0])
        if len(starts) > 2:
            odd.add(piece)
    by_score: dict[float, list[str]] = {}
    for r in rows:
        by_score.setdefault(r[2], []).append(r[0])
    return odd | {p for same in by_score.values() if len(same) > 1 for p in same if len(p) > 1}


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at.cast("int"))


def byte_ids(character: Column, first_byte: int) -> Column:
    """The ids of a character's UTF-8 bytes."""
    code = F.hex(F.encode(character, "UTF-8"))
    return F.transform(F.sequence(F.lit(0), (F.length(code) / 2).cast("int") - 1), lambda k: F.conv(F.substring(code, k * 2 + 1, F.lit(2)), 16, 10).cast("int") + first_byte)


def _first(x: Column) -> Column:
    return F.call_function("shiftright", x, F.lit(6)).bitwiseAND(F.lit(63))


def _end(x: Column) -> Column:
    return x.bitwiseAND(F.lit(63))


def _inside(x: Column, b: Column) -> Column:
    """The starts strictly inside an edge."""
    return b.bitwiseAND(_bit(_end(x)) - _bit(_first(x) + 1))


def _stands(x: Column, b: Column) -> Column:
    """Whether both ends of an edge are starts."""
    ends = _bit(_first(x)).bitwiseOR(_bit(_end(x)))
    return b.bitwiseAND(ends) == ends


def merges() -> Column:
    """The starts of a word's segments under a BPE model, as bits of a long; its end counts as one.

    Edges are met once in the order of their ranks, then from the left: an edge of two neighbouring segments clears the
    start between them. Words with a piece for which one pass might not do take the best merge again and again.
    """
    n = F.length("word")
    begun = _bit(n + 1) - F.lit(1).cast("long")
    once = F.aggregate(F.sort_array("edges"), begun, lambda b, x: F.when(_stands(x, b) & (F.bit_count(_inside(x, b)) == 1), b.bitwiseXOR(_inside(x, b))).otherwise(b))

    def step(b: Column, _: Column) -> Column:
        best = F.array_min(F.filter("edges", lambda x: _stands(x, b) & (F.bit_count(_inside(x, b)) == 1)))
        return F.when(best.isNull(), b).otherwise(b.bitwiseXOR(_inside(best, b)))

    again = F.aggregate(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), begun, step)
    return F.when(F.col("odd"), again).otherwise(once)


def _constant(values: list, kind: str) -> Column:
    """A constant array, folded once."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def by_ranks(lattice: DataFrame, first_byte: int, by_rank: list[int], by_character: list[int]) -> DataFrame:
    """(word, ids) under a BPE model, whose ids are given by rank, and those of single characters by code point (-1: none)."""
    n = F.length("word")
    low = F.lit((1 << 32) - 1)
    state = lattice.withColumn("starts", merges())
    path = F.filter("edges", lambda x: _stands(x, F.col("starts")) & (_inside(x, F.col("starts")) == 0))
    placed = lambda first, i: F.call_function("shiftleft", first.cast("long"), F.lit(32)).bitwiseOR(i.cast("long"))
    longer = F.transform(path, lambda x: placed(_first(x), F.get(_constant(by_rank, "int"), F.call_function("shiftright", x, F.lit(12)).cast("int"))))
    alone = F.filter(F.sequence(F.lit(0), n - 1), lambda at: F.call_function("shiftrightunsigned", F.col("starts"), at).bitwiseAND(F.lit(3)) == 3)
    character = lambda at: F.col("word").substr(at + 1, F.lit(1))
    # An unknown character has all low bits set.
    single = F.transform(alone, lambda at: placed(at, F.coalesce(F.nullif(F.get(_constant(by_character, "int"), F.ascii(character(at))), F.lit(-1)).cast("long"), low)))
    state = state.withColumn("path", F.sort_array(F.concat(longer, single)))
    plain = F.transform("path", lambda p: p.bitwiseAND(low).cast("int"))
    with_bytes = F.flatten(F.transform("path", lambda p: F.when(p.bitwiseAND(low) == low, byte_ids(character(F.call_function("shiftright", p, F.lit(32)).cast("int")), first_byte)).otherwise(F.array(p.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")))))
    return state.select("word", F.when(F.exists("path", lambda p: p.bitwiseAND(low) == low), with_bytes).otherwise(plain).alias("ids"))


def by_scores(lattice: DataFrame, first_byte: int, worst: float) -> DataFrame:
    """(word, ids, score) by Viterbi under a unigram model, whose worst score is given."""
    n, unknown = F.length("word"), F.lit(worst - UNKNOWN_PENALTY)

    def reach(best: Column, e: Column) -> Column:
        known = F.transform(F.filter("edges", lambda x: x["end"] == e), lambda x: F.struct((F.get(best, x["first"])["score"] + x["score"]).alias("score"), (-x["first"]).alias("back"), x["id"].alias("id")))
        other = F.struct((F.get(best, e - 1)["score"] + unknown).alias("score"), (F.lit(1) - e).alias("back"), F.lit(-1).alias("id"))
        covered = F.exists("edges", lambda x: (x["end"] == e) & (x["first"] == e - 1))
        return F.concat(best, F.array(F.array_max(F.when(covered, known).otherwise(F.concat(known, F.array(other))))))

    start = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("back"), F.lit(-1).alias("id")))
    state = lattice.withColumn("best", F.aggregate(F.sequence(F.lit(1), n), start, reach))
    # Backwards along the best edges: (where the walk stands, starts met).
    walk = F.aggregate(F.sequence(F.lit(1), n), F.struct(n.alias("at"), F.array().cast("array<struct<first:int,id:int>>").alias("met")), lambda s, _: F.when(s["at"] <= 0, s).otherwise(F.struct((-F.get("best", s["at"])["back"]).alias("at"), F.concat(F.array(F.struct((-F.get("best", s["at"])["back"]).alias("first"), F.get("best", s["at"])["id"].alias("id"))), s["met"]).alias("met"))))
    state = state.withColumn("met", walk["met"])
    ids = F.flatten(F.transform("met", lambda x: F.when(x["id"] >= 0, F.array(x["id"])).otherwise(byte_ids(F.col("word").substr(x["first"] + 1, F.lit(1)), first_byte))))
    return state.select("word", ids.alias("ids"), F.get("best", n)["score"].alias("score"))


class Pieces:
    """A model's piece table, and what the folds take from it."""

    def __init__(self, path: str):
        import sentencepiece

        self.first_byte = sentencepiece.SentencePieceProcessor(model_file=path).piece_to_id("<0x00>")
        self.rows = ranked(piece_rows(path))
        self.longest = max(len(r[0]) for r in self.rows)
        self.worst = min(r[2] for r in self.rows)

    def frame(self, spark: SparkSession) -> DataFrame:
        odd = out_of_order(self.rows)
        return spark.createDataFrame([(*r, r[0] in odd) for r in self.rows], "piece string, id int, score double, rank int, odd boolean")

    def codes(self, distinct: DataFrame) -> DataFrame:
        """(word, ids) of distinct words of at most LONGEST characters."""
        by_rank = [i for _, i in sorted((r[3], r[1]) for r in self.rows)]
        characters = {ord(r[0]): r[1] for r in self.rows if len(r[0]) == 1}
        by_character = [characters.get(c, -1) for c in range(max(characters, default=0) + 1)]
        return by_ranks(edges(distinct, self.frame(distinct.sparkSession), self.longest, F.expr(PACKED), 2), self.first_byte, by_rank, by_character)


def merged(word: str, rank: dict[str, int], ids: dict[str, int], first_byte: int) -> list[int]:
    """The ids of a word of any length: the best merge again and again, the leftmost of equals, from a heap."""
    n = len(word)
    end = list(range(1, n + 1))  # of the segment that starts here
    before = list(range(-1, n - 1))
    alive = [True] * n
    heap = [(rank[word[i : i + 2]], i, i + 2) for i in range(n - 1) if word[i : i + 2] in rank]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if not alive[i] or middle >= n or end[middle] != stop or middle >= stop:
            continue
        end[i], alive[middle] = stop, False
        if stop < n:
            before[stop] = i
            if (r := rank.get(word[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (p := before[i]) >= 0 and (r := rank.get(word[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    out, at = [], 0
    while at < n:
        piece = word[at : end[at]]
        out += [ids[piece]] if piece in ids else [first_byte + b for b in piece.encode("utf-8", "surrogatepass")]
        at = end[at]
    return out


class Known:
    """The words whose ids are broadcast, and the pieces for words that are too long for a lattice."""

    def __init__(self, found: list[str], ends: np.ndarray, ids: np.ndarray, pieces: list[tuple[str, int, float, int]], first_byte: int):
        self.places = {w: k for k, w in enumerate(found)}
        self.ends, self.ids, self.first_byte = ends, ids, first_byte
        self.starts = np.append(0, ends[:-1]).astype(np.int64) if len(ends) else ends
        self.rank, self.piece_ids = {r[0]: r[3] for r in pieces}, {r[0]: r[1] for r in pieces}

    def look_up(self, seen: list[str]) -> np.ndarray:
        """Each word's place in the table; -1 for those outside."""
        return np.fromiter(map(self.places.get, seen, repeat(-1)), np.int32, len(seen))

    def long(self, word: str) -> np.ndarray:
        return np.array(merged(word, self.rank, self.piece_ids, self.first_byte), np.int32)

    def of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids of the words at these places, how many each has)."""
        sizes = self.ends[places] - self.starts[places]
        shift = self.starts[places] - (np.cumsum(sizes) - sizes)
        return self.ids[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))], sizes


_TABLES: dict[str, Known] = {}


def _known(name: str, shared) -> Known:
    """A worker's table, made once from the broadcast and kept from task to task."""
    if name not in _TABLES:
        _TABLES.clear()
        _TABLES[name] = Known(*shared.value)
    return _TABLES[name]


def frequent_words(docs: DataFrame, id_col: str, text_col: str, most: int = FREQUENT, sample: int = SAMPLE_DOCS) -> DataFrame:
    """(word): the most frequent of at most SHORT characters in about `sample` documents."""
    share = max(1, docs.count() // sample)
    rows = docs.where(F.pmod(F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), F.lit(share)) == 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter[str] = Counter()
            for text in batch.column(0):
                for part in segments(text.as_py() or ""):
                    seen.update(_WORD.findall(part))
            short = [w for w in seen if len(w) <= SHORT]
            yield pa.RecordBatch.from_arrays([pa.array(short, pa.string()), pa.array([seen[w] for w in short], pa.int64())], ["word", "n"])

    counted = rows.select(F.col(f"`{text_col}`").cast("string")).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.orderBy(F.desc("n"), "word").limit(most).select("word").repartition(width(docs.sparkSession), "word")


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """(id_col, text_key, position, ids): the runs of frequent words and the other words of each document."""
    spark, pieces = docs.sparkSession, Pieces(path or model_file())
    found = pieces.codes(frequent_words(docs, id_col, text_col, frequent)).toArrow().combine_chunks()
    ids = found.column("ids").combine_chunks()
    sizes = pa.compute.list_value_length(ids).to_numpy(zero_copy_only=False).astype(np.int64) if len(ids) else np.zeros(0, np.int64)
    shared = spark.sparkContext.broadcast((found.column("word").to_pylist(), np.cumsum(sizes), ids.flatten().to_numpy(zero_copy_only=False).astype(np.int32), pieces.rows, pieces.first_byte))
    name = uuid.uuid4().hex
    key, position, codes = (free(n, [id_col]) for n in ("text_key", "position", "ids"))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def split(batch: pa.RecordBatch, table: Known) -> Iterator[tuple[int, int, list[str], np.ndarray]]:
        """(row, place of the first word, words, their places in the table) of each part of each text."""
        for row, text in enumerate(batch.column(2)):
            at = 0
            for part in segments(text.as_py()):
                seen = _WORD.findall(part)
                yield row, at, seen, table.look_up(seen)
                at += len(seen)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _known(name, shared)

        def direct(batch: pa.RecordBatch) -> pa.RecordBatch:
            of_row, places, all_ids, all_sizes = [], [], [], []
            for row, begin, seen, at in split(batch, table):
                fine = np.flatnonzero(at >= 0)
                if len(fine):
                    first = np.flatnonzero(np.diff(fine, prepend=-2) > 1)
                    ids, sizes = table.of(at[fine])
                    of_row.append(np.full(len(first), row))
                    places.append(fine[first] + begin)
                    all_ids.append(ids)
                    all_sizes.append(np.add.reduceat(sizes, first))
                for k in np.flatnonzero(at < 0).tolist():
                    if len(seen[k]) > LONGEST:
                        ids = table.long(seen[k])
                        of_row.append([row]), places.append([k + begin]), all_ids.append(ids), all_sizes.append([len(ids)])
            empty = np.flatnonzero([not len(t.as_py()) for t in batch.column(2)])
            of_row.append(empty), places.append(np.zeros(len(empty))), all_sizes.append(np.zeros(len(empty)))
            of_row = pa.array(np.concatenate(of_row).astype(np.int64))
            ends = np.append(0, np.cumsum(np.concatenate(all_sizes))).astype(np.int32)
            values = pa.array(np.concatenate([np.zeros(0, np.int32), *all_ids]), pa.int32())
            return pa.RecordBatch.from_arrays([batch.column(0).take(of_row), batch.column(1).take(of_row), pa.array(np.concatenate(places).astype(np.int64)), pa.ListArray.from_arrays(pa.array(ends), values)], ["id", "key", "position", "ids"])

        return batched(direct, batches, BATCH)

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _known(name, shared)

        def rare(batch: pa.RecordBatch) -> pa.RecordBatch:
            of_row, names, places = [], [], []
            for row, begin, seen, at in split(batch, table):
                mine: dict[str, list[int]] = {}
                for k in np.flatnonzero(at < 0).tolist():
                    if len(seen[k]) <= LONGEST:
                        mine.setdefault(seen[k], []).append(k + begin)
                of_row += [row] * len(mine)
                names += mine
                places += mine.values()
            of_row = pa.array(of_row, pa.int64())
            return pa.RecordBatch.from_arrays([batch.column(0).take(of_row), batch.column(1).take(of_row), pa.array(names, pa.string()), pa.array(places, pa.list_(pa.int64()))], ["id", "key", "word", "places"])

        return batched(rare, batches, BATCH)

    direct = rows.mapInArrow(runs, f"id {kind}, key long, position long, ids array<int>")
    # What the join and the explosion below would filter is filtered before the shuffle, and all columns are read by the
    # grouping, so that both uses of the other words read one shuffle and split the texts once.
    full = F.col("word").isNotNull() & (F.size("places") > 0) & F.col("places").isNotNull()
    rare = rows.mapInArrow(others, f"id {kind}, key long, word string, places array<long>").where(full).repartition(width(spark), "word")
    seen = F.xxhash64("id", "key", "places")
    distinct = rare.groupBy("word").agg(F.min(seen).alias("least"), F.max(seen).alias("most")).where("least <= most").select("word")
    joined = rare.join(pieces.codes(distinct).hint("merge"), "word").select("id", "key", F.explode("places").alias("position"), "ids")
    return direct.union(joined).select(F.col("id").alias(id_col), F.col("key").alias(key), F.col("position").alias(position), F.col("ids").alias(codes))


def gathered(encoded: DataFrame, value: Column, id_col: str, out: str, whole: Column) -> DataFrame:
    """(id_col, out) of each document: whole is made of the array `parts`, the values of the document's rows in order."""
    key, position = (free(n, [id_col]) for n in ("text_key", "position"))
    rows = encoded.select(F.col(f"`{id_col}`").alias("id"), F.col(key).alias("key"), F.col(position).alias("place"), value.alias("value"))
    # Rows of copies are equal: one of each stays, before the shuffle already.
    once = rows.groupBy("id", "key", "place", "value").agg(F.count(F.lit(1)).alias("n"))
    ordered = F.array_sort(F.collect_list(F.struct("place", "value")))
    each = once.groupBy("id", "key").agg(F.transform(ordered, lambda x: x["value"]).alias("parts"), F.max(F.when(F.col("place") == 0, F.col("n"))).alias("copies"))
    return each.select("id", whole.alias("whole"), F.explode(F.sequence(F.lit(1), F.col("copies")))).select(F.col("id").alias(id_col), F.col("whole").alias(out))


def by_document(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id_col, ids) of each document."""
    codes = free("ids", [id_col])
    return gathered(encoded, F.col(codes), id_col, codes, F.flatten("parts"))


def decode(encoded: DataFrame, path: str | None = None, id_col: str = "doc_id") -> DataFrame:
    """(id_col, text) of each document that encode() gave."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path or model_file())
    text = lambda i: b"" if m.is_control(i) else m.decode([i]).encode() if m.is_unknown(i) else bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace(SPACE, " ").encode()
    table = _constant([text(i).hex() for i in range(m.get_piece_size())], "string")
    part = F.array_join(F.transform(free("ids", [id_col]), lambda i: F.get(table, i)), "")
    joined = F.make_valid_utf8(F.unhex(F.array_join("parts", "")).cast("string"))
    # The space that encoding puts in front goes.
    return gathered(encoded, part, id_col, free("text", [id_col]), F.regexp_replace(joined, "^ ", ""))


def viterbi_words(docs: DataFrame, path: str | None = None, text_col: str = "text") -> DataFrame:
    """(word, ids, score): the best path by sum of scores of each distinct word of at most LONGEST characters in docs, for
    models whose scores add up."""
    pieces = Pieces(path or model_file())

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = {w for text in batch.column(0) for part in segments(text.as_py() or "") for w in _WORD.findall(part) if len(w) <= LONGEST}
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string())], ["word"])

    distinct = docs.select(F.col(f"`{text_col}`").cast("string")).mapInArrow(split, "word string").distinct()
    return by_scores(edges(distinct, pieces.frame(docs.sparkSession), pieces.longest, F.expr(SCORED)), pieces.first_byte, pieces.worst)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))


def round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    back = decode(encode(table(spark, sf_dir, "documents")))
    return back.select("doc_id", F.sha2("text", 256).alias("text_sha256"))


def viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = viterbi_words(table(spark, sf_dir, "documents"))
    return found.select("word", F.array_join(F.transform("ids", lambda i: i.cast("string")), " ").alias("ids"), "score")


QUERIES = {"op4_lattice_sentencepiece": op4, "pieces_round_trip": round_trip, "pieces_viterbi_words": viterbi}

#: What a lossless round trip gives.
ORACLE = {"pieces_round_trip": "SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents"}

"""Benchmark decontamination by a distributed positional inverted index.

*Index.*  Documents are tokenized once, in blocks of a few megabytes of
text.  A block's postings (for each term the first position and the gaps to
the next ones) are one row of a Parquet table, so the index is spread like
the documents are, and a search never sees texts again.  Positions run on through the block's
documents with a gap between two, which no phrase spans.

*Search.*  The test items are broadcast in chunks of bounded size, one after
the other; of several chunks each one's matches are written before the next
is read.  In each block, a window of terms is only looked at if all its terms occur.  Its
candidates are the postings of its rarest term, moved back by that term's
offset; the other terms, from rare to frequent, strike out those at whose
offset they don't stand.  What is left are exact phrases.  A proximity match
is an occurrence of the rarest term with every other term of the window no
further away than the window is long plus ``slack``.

Words are as in ``text.py``.  A window has ``window`` consecutive words of
an item; an item of fewer words, but not none, is one window.  Null text has
no words.  Items with a null item_id are ignored; rows that repeat an
item_id are one item with the windows of all.  Rows that repeat a doc_id are
all returned.  Further columns are ignored.  Empty tables give empty
results, or documents without matches.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import as_ids, numbered, small_batches, without, written
from .text import U64, parts, string_bytes, word_hashes, words

#: Words between two documents of a block at least; phrases and their proximity don't reach over.
GAP = 64
#: Characters of test items that are broadcast at once (as windows some eight bytes each).
CHUNK_CHARS = 2 << 20
INDEX_SCHEMA = ("block string, doc_ids binary, doc_nulls binary, doc_words binary, "
                "terms binary, term_counts binary, gaps binary")
SPANS = "array<struct<item_id:string,start:long,length:long>>"
MATCH_SCHEMA = f"block string, doc_no int, doc_id long, n_words long, spans {SPANS}, near array<string>"


def gap_for(window: int, slack: int | None) -> int:
    """Words between two documents that no match of this reach gets over."""
    return max(GAP, window + (slack or 0) + 1)


def build_index(docs: DataFrame, gap: int = GAP) -> DataFrame:
    """The written positional index of doc_id, text."""
    small_batches(docs.sparkSession)
    names = ["block", "doc_ids", "doc_nulls", "doc_words", "terms", "term_counts", "gaps"]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "text"):
                h, offsets = words(*string_bytes(part.column(1)))
                n_words = np.diff(offsets)
                at = np.arange(len(h)) + np.repeat(np.arange(len(n_words)) * gap, n_words)
                order = np.argsort(h, kind="stable")
                ranked = h[order]
                first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(h) else order
                gaps = at[order]
                gaps[1:] -= gaps[:-1].copy()
                gaps[first] = at[order][first]
                ids = part.column(0)
                row = [uuid.uuid4().hex, ids.fill_null(0).to_numpy().astype("<i8").tobytes(),
                       ids.is_null().to_numpy(False).astype(np.uint8).tobytes(), n_words.astype("<i8").tobytes(),
                       ranked[first].tobytes(), np.diff(np.append(first, len(h))).astype("<u4").tobytes(),
                       gaps.astype("<u4").tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=names)

    return written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(index, INDEX_SCHEMA),
                   "positional-index", compression="zstd")


class Windows:
    """The windows of some test items: terms by number, padded with the last
    term, so that a short window just checks its last word again."""

    def __init__(self, items: list[tuple[str, str]], size: int):
        rows, self.owner, self.length = [], [], []
        for (item_id, _), h in zip(items, word_hashes([t or "" for _, t in items])):
            for k in range(max(len(h) - size + 1, 1 if len(h) else 0)):
                w = h[k:k + size]
                rows.append(np.concatenate([w, np.repeat(w[-1:], size - len(w))]))
                self.owner.append(item_id)
                self.length.append(len(w))
        grid = np.array(rows, U64).reshape(-1, size)
        self.terms, numbers = np.unique(grid, return_inverse=True)
        self.numbers = numbers.reshape(grid.shape).astype(np.int32)
        self.length = np.array(self.length, np.int32)

    def offset(self, which: np.ndarray) -> np.ndarray:
        """Where the terms of these windows stand from their start."""
        return np.minimum(np.arange(self.numbers.shape[1]), self.length[which, None] - 1)


class Block:
    """A row of the index, opened for the terms of some windows."""

    def __init__(self, row: dict, windows: Windows, gap: int):
        self.n_words = np.frombuffer(row["doc_words"], "<i8")
        nulls = np.frombuffer(row["doc_nulls"], np.uint8)
        self.doc_ids = [None if z else int(d) for d, z in zip(np.frombuffer(row["doc_ids"], "<i8"), nulls)]
        self.doc_start = np.cumsum(self.n_words + gap) - self.n_words - gap
        terms, counts = np.frombuffer(row["terms"], "<u8"), np.frombuffer(row["term_counts"], "<u4").astype(np.int64)
        gaps = np.frombuffer(row["gaps"], "<u4")
        starts = np.cumsum(counts) - counts
        at = np.minimum(np.searchsorted(terms, windows.terms), max(len(terms) - 1, 0))
        there = terms[at] == windows.terms if len(terms) else np.zeros(len(windows.terms), bool)
        self.count = np.where(there, counts[at], 0) if len(terms) else np.zeros(len(windows.terms), np.int64)
        start = starts[at] if len(terms) else self.count
        self.first = np.cumsum(self.count) - self.count
        own = gaps[np.repeat(start - self.first, self.count) + np.arange(self.count.sum())].astype(np.int64)
        upto = np.concatenate([[0], np.cumsum(own)])
        self.postings = upto[1:] - np.repeat(upto[self.first], self.count)
        #: term that stands at a position, -1 for one of no window
        self.term_at = np.full(int(self.n_words.sum()) + (len(self.n_words) + 1) * gap, -1, np.int32)
        self.term_at[self.postings] = np.repeat(np.arange(len(windows.terms)), self.count)

    def postings_of(self, term: int) -> np.ndarray:
        return self.postings[self.first[term]:self.first[term] + self.count[term]]


def phrases(block: Block, windows: Windows, live: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows and start positions of the exact occurrences of the windows ``live``."""
    numbers, offset = windows.numbers[live], windows.offset(live)
    by_rarity = np.argsort(block.count[numbers], axis=1, kind="stable")
    rarest = by_rarity[:, 0]
    term = numbers[np.arange(len(live)), rarest]
    n = block.count[term]
    upto = np.cumsum(n) - n
    which = np.repeat(np.arange(len(live)), n)
    at = block.postings[np.repeat(block.first[term] - upto, n) + np.arange(n.sum())]
    start = at - offset[which, rarest[which]]
    ok = start >= 0
    which, start = which[ok], start[ok]
    for k in range(1, numbers.shape[1]):
        col = by_rarity[which, k]
        stands = block.term_at[start + offset[which, col]] == numbers[which, col]
        which, start = which[stands], start[stands]
    return live[which], start


def neighbours(block: Block, windows: Windows, live: np.ndarray, slack: int) -> list[tuple[str, int]]:
    """(item, position of the rarest term) of proximity matches."""
    found = []
    for w in live:
        terms = np.unique(windows.numbers[w])
        terms = terms[np.argsort(block.count[terms], kind="stable")]
        at = block.postings_of(terms[0])
        reach = int(windows.length[w]) - 1 + slack
        for t in terms[1:]:
            p = block.postings_of(t)
            k = np.searchsorted(p, at - reach)
            at = at[(k < len(p)) & (p[np.minimum(k, len(p) - 1)] <= at + reach)]
            if not len(at):
                break
        found += [(windows.owner[w], int(p)) for p in at]
    return found


def spans_of(block: Block, windows: Windows, which: np.ndarray, start: np.ndarray) -> dict[int, list[dict]]:
    """By document number: what each item covers, as stretches without holes."""
    doc = np.searchsorted(block.doc_start, start, "right") - 1
    out: dict[int, list[dict]] = {}
    last: dict[tuple[int, str], dict] = {}
    for i in np.argsort(start, kind="stable"):
        d, item = int(doc[i]), windows.owner[which[i]]
        a, n = int(start[i] - block.doc_start[d]), int(windows.length[which[i]])
        span = last.get((d, item))
        if span and a <= span["start"] + span["length"]:
            span["length"] = max(span["length"], a + n - span["start"])
        else:
            last[d, item] = span = {"item_id": item, "start": a, "length": n}
            out.setdefault(d, []).append(span)
    return out


def search(index: DataFrame, items: list[tuple[str, str]], window: int, slack: int | None, gap: int = GAP) -> DataFrame:
    """One row per document of the index: its spans of exact phrases and,
    with ``slack``, its items with proximity matches."""
    index.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    windows = Windows(items, window)
    kind = pa.schema([("block", pa.string()), ("doc_no", pa.int32()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
                      ("spans", pa.list_(pa.struct([("item_id", pa.string()), ("start", pa.int64()), ("length", pa.int64())]))),
                      ("near", pa.list_(pa.string()))])

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, windows, gap)
                live = np.flatnonzero((block.count[windows.numbers] > 0).all(1))
                found = spans_of(block, windows, *phrases(block, windows, live)) if len(live) else {}
                near: dict[int, set[str]] = {}
                if slack is not None:
                    for item, p in neighbours(block, windows, live, slack):
                        near.setdefault(int(np.searchsorted(block.doc_start, p, "right")) - 1, set()).add(item)
                n = len(block.doc_ids)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["block"]] * n), pa.array(range(n), pa.int32()), pa.array(block.doc_ids, pa.int64()),
                    pa.array(block.n_words), pa.array([found.get(d, []) for d in range(n)], kind.field("spans").type),
                    pa.array([sorted(near.get(d, ())) for d in range(n)], pa.list_(pa.string()))], schema=kind)

    return index.mapInArrow(match, MATCH_SCHEMA)


def item_chunks(benchmark: DataFrame, chunk_chars: int) -> Iterator[tuple[list[tuple[str, str]], bool]]:
    """The items (as strings) in chunks of about ``chunk_chars`` characters,
    one after the other, and whether a chunk is the last; the whole table is
    never on the driver at once."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").filter("item_id is not null")
    chars = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    chunks = int(chars // chunk_chars) + 1
    for k in range(chunks):
        part = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(chunks)) == k) if chunks > 1 else items
        yield [(r["item_id"], r["text"]) for r in part.collect()], k + 1 == chunks


def matches(docs: DataFrame, benchmark: DataFrame, window: int = 10, slack: int | None = None,
            chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """doc_id, n_words, spans (item_id, start word, words), near (items with
    proximity matches) of every document."""
    gap = gap_for(window, slack)
    index = build_index(docs, gap)
    together = None
    for items, last in item_chunks(benchmark, chunk_chars):
        found = search(index, items, window, slack, gap)
        if together is None and last:
            return found.select("doc_id", "n_words", "spans", "near")
        found = written(found, "matches")  # the chunk isn't needed any more
        together = found if together is None else together.unionByName(found)
    return together.groupBy("block", "doc_no").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.flatten(F.collect_list("near")).alias("near")).drop("block", "doc_no")


def covered(spans: Column) -> Column:
    """Words that lie in at least one span."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("a"), (s["start"] + s["length"]).alias("b"))))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(ordered, zero, lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0).cast("long"), s["b"] - F.greatest(acc["end"], s["a"]))).alias("n"),
        F.greatest(acc["end"], s["b"]).alias("end")), lambda acc: acc["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, slack: int | None = None) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items, contaminated, n_near_items."""
    found = matches(docs, benchmark, window, slack)
    return found.select(
        "doc_id", "n_words", covered(F.col("spans")).alias("n_hit"),
        F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["item_id"]))).alias("items"),
        F.size(F.array_distinct("near")).cast("long").alias("n_near_items"),
    ).withColumns({"n_items": F.size("items").cast("long"), "contaminated": F.col("n_hit") > 0})


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs."""
    rows, number = numbered(docs)
    found = contamination(as_ids(rows, number), benchmark, window)
    return without(rows, number, found.filter("contaminated").select("doc_id"))

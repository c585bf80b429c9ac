"""Removal of long repeats: every byte that a string of BYTES.length bytes covers which also starts anywhere else in the corpus.
Passages, strings of WORDS.length words that also start anywhere else, are found by the same means over codes of words.

A window is that many symbols (bytes or words) of one text. Its anchor is the gram of least hash within it, so equal windows
have equal anchors. Consecutive windows of a text with equal anchors are a segment, of MOST windows at most; a text that
repeats itself at once, such as one letter over and over, has few of them. Segments are compared by anchor only:

1. a scan names the segments of every text (anchor, place, digest of the content); anchors met once are done, unless the segment
   itself holds its anchor at several places;
2. segments with equal bytes are collapsed to one, with the number of its copies;
3. one of each is fetched where an anchor has several contents, and dealt to shards by anchor; each shard builds a
   run-length index (runindex.py) over them and streams matching statistics, and a window is a repeat if its statistic reaches
   the length, or if its segment has copies;
4. repeats go back to all members, and each text is cut once.

An anchor with more than HOT distinct contents (a passage at the edge of which all differ) isn't held in one shard: it is
salted over several, each with its index, and what they can't tell alone is compared across them. Texts are shuffled only
as far as segments are fetched or removed; a bit table of fixed size filters them first.

Words are compared by 32-bit codes of their lower-cased form, so what stands between them doesn't matter; a window by all its codes.

A null text is empty; texts shorter than a window keep all; repeated rows are copies of each other; a null doc_id is kept; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velograph.llm.runindex import long_matches
from velograph.llm.shared import bit_table, settle, whole_text
from velograph.llm.words import hash_each


@dataclass(frozen=True)
class Window:
    """length: symbols of a window; gram: symbols of its anchor, a power of two; kind: the numpy type of a symbol."""

    length: int
    gram: int
    kind: str

    @property
    def width(self) -> int:
        return np.dtype(self.kind).itemsize


BYTES, WORDS = Window(400, 128, "u1"), Window(50, 16, "<u4")
#: Windows of a segment.
MOST = 4096
#: Symbols of a text or of several texts hashed at once; places within them fit PLACE_BITS.
PIECE, PLACE_BITS = 1 << 20, 22
SHARD_BYTES, HOT, TABLE_BITS = 400_000, 1536, 24

_U = np.uint64
_ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3]
SEGMENTS = "doc_id long, key long, at int, n short, again boolean, anchor long, d1 long, d2 long"
ROW = ["doc_id", "key"]
CONTENT = ["anchor", "d1", "d2"]


def spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


BYTE_CODE = spread(np.arange(1, 257, dtype=_U) * _U(_ODD[0]))


def symbols(texts: list[bytes], window: Window) -> list[np.ndarray]:
    """Each text in symbols. The largest number of their type is none (no byte of UTF-8 is, and word codes end below it)."""
    if window.width == 1:
        return [np.frombuffer(t, np.uint8) for t in texts]
    return [np.minimum(h >> _U(32), _U(0xFFFFFFFE)).astype(window.kind) for h in hash_each(texts)]


def gram_hashes(x: np.ndarray, gram: int) -> np.ndarray:
    """Hashes of all strings of gram symbols, by doubling."""
    h, width = BYTE_CODE[x] if x.dtype == np.uint8 else spread((x.astype(_U) + _U(1)) * _U(_ODD[0])), 1
    for odd in _ODD[: gram.bit_length() - 1]:
        h = h[:-width] * _U(odd) + (h[width:] ^ (h[width:] >> _U(29)))
        width *= 2
    return spread(h)


def sliding_minimum(x: np.ndarray, w: int) -> np.ndarray:
    """Minima of w consecutive numbers (running minima of blocks from both sides)."""
    n = len(x)
    blocks = np.full(-(-n // w) * w, np.iinfo(_U).max, _U)
    blocks[:n] = x
    rows = blocks.reshape(-1, w)
    forth = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], forth[w - 1 : n])


def pieces(texts: list[np.ndarray], length: int) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """Groups of (number of the text, offset, symbols), PIECE symbols or so each; a longer text comes in overlapping parts, so
    that every window is in one."""
    group, size = [], 0
    for i, t in enumerate(texts):
        if len(t) < length:
            continue
        for start in range(0, len(t) - length + 1, PIECE):
            part = t[start : start + PIECE + length - 1]
            if group and size + len(part) > PIECE + length:
                yield group
                group, size = [], 0
            group.append((i, start, part))
            size += len(part)
    if group:
        yield group


def segments(texts: list[np.ndarray], window: Window) -> Iterator[tuple[np.ndarray, ...]]:
    """Number of the text, first window, number of windows, whether its anchor stands at several places, anchor, and digest (two
    numbers) of the content, of every segment."""
    length, width = window.length, window.width
    for group in pieces(texts, length):
        x = np.concatenate([g[2] for g in group])
        raw = x.tobytes()
        h = gram_hashes(x, window.gram)
        low = _U((1 << PLACE_BITS) - 1)
        least = sliding_minimum((h & ~low) | np.arange(len(h), dtype=_U), length - window.gram + 1)
        place = (least & low).astype(np.int64)
        owner = np.repeat(np.arange(len(group)), [len(g[2]) for g in group])
        base = np.cumsum([0] + [len(g[2]) for g in group])
        valid = np.zeros(len(x), bool)
        for k in range(len(group)):
            valid[base[k] : base[k + 1] - length + 1] = True
        at = np.flatnonzero(valid[: len(place)])
        place = place[at]
        anchor = h[place]
        fresh = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (owner[at[1:]] != owner[at[:-1]])))
        new = np.flatnonzero(fresh)
        since = np.arange(len(at)) - np.repeat(new, np.diff(np.append(new, len(at))))
        new = np.flatnonzero(since % MOST == 0)
        first = at[new]
        count = np.diff(np.append(new, len(at)))
        moved = np.concatenate(([False], place[1:] != place[:-1]))
        moved[new] = False
        again = np.logical_or.reduceat(moved, new)
        digest = np.frombuffer(b"".join([hashlib.blake2b(raw[s * width : (s + n + length - 1) * width], digest_size=16).digest() for s, n in zip(first.tolist(), count.tolist(), strict=True)]), np.int64).reshape(-1, 2)
        k = owner[first]
        number = np.array([g[0] for g in group])[k]
        offset = np.array([g[1] for g in group])[k] + first - base[k]
        yield number, offset, count, again, anchor[new].view(np.int64), digest[:, 0], digest[:, 1]


def encoded(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of rows with about PIECE bytes of text: number of the first, texts."""
    start, size, held = 0, 0, []
    for i, v in enumerate(batch.column(column)):
        held.append(v.as_py().encode("utf-8", "replace"))
        size += len(held[-1])
        if size >= PIECE:
            yield start, held
            start, size, held = i + 1, 0, []
    if held:
        yield start, held


def own_rows(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(whole_text(text)).alias("key"), whole_text(text).alias("text"))


def name_segments(docs: DataFrame, window: Window = BYTES, text: str = "text") -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int32(), pa.int16(), pa.bool_(), pa.int64(), pa.int64(), pa.int64())
        for batch in batches:
            for start, texts in encoded(batch, 2):
                for number, *cols in segments(symbols(texts, window), window):
                    rows = pa.array(number + start)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], names=[x.split()[0] for x in SEGMENTS.split(", ")])

    return settle(own_rows(docs, text).mapInArrow(run, SEGMENTS), "segments")


def matching_rows(docs: DataFrame, wanted: DataFrame, text: str) -> DataFrame:
    """doc_id, key, text of documents whose key may be among wanted's: texts that aren't needed stay out of the shuffle."""
    held = docs.sparkSession.sparkContext.broadcast(bit_table(wanted, F.col("key"), TABLE_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(held.value, np.int64)
        for b in batches:
            at = np.asarray(b.column(1)) & ((1 << TABLE_BITS) - 1)
            yield b.filter(pa.array((bits[at >> 6] >> (at & 63)) & 1 == 1))

    return own_rows(docs, text).mapInArrow(run, "doc_id long, key long, text string")


def fetch(docs: DataFrame, wanted: DataFrame, window: Window, text: str) -> DataFrame:
    """anchor, d1, d2, copies, content of the segments that wanted names by doc_id, key, at and n. Written out."""
    lists = wanted.groupBy(*ROW).agg(F.collect_list(F.struct("at", "n", "anchor", "d1", "d2", "copies")).alias("found"))
    lists = settle(lists.select(F.col("doc_id").alias("__doc"), F.col("key").alias("__key"), "found"), "fetch-lists")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x = symbols([batch.column(0)[i].as_py().encode("utf-8", "replace")], window)[0]
                found = batch.column(1)[i].values
                at, n = found.field("at").to_pylist(), found.field("n").to_pylist()
                yield pa.RecordBatch.from_arrays([*(found.field(c) for c in (*CONTENT, "copies")), pa.array([x[s : s + k + window.length - 1].tobytes() for s, k in zip(at, n, strict=True)], pa.binary())], names=[*CONTENT, "copies", "content"])

    rows = matching_rows(docs, lists.select(F.col("__key").alias("key")), text)
    joined = rows.join(lists, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("key") == F.col("__key"))).select("text", "found")
    # rows equal in doc_id and text are fetched once each
    return settle(joined.mapInArrow(run, "anchor long, d1 long, d2 long, copies long, content binary").dropDuplicates(CONTENT), "fetched")


def judge(contents: list[bytes], copies: list[int], window: Window) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each content in symbols, and which of its windows are met again."""
    strings = [np.frombuffer(c, window.kind) for c in contents]
    for s, own, m in zip(strings, long_matches(strings, window.length), copies, strict=True):
        n = len(s) - window.length + 1
        yield s, np.ones(n, bool) if m > 1 else own[:n]


def indexed_repeats(fetched: DataFrame, window: Window) -> DataFrame:
    """anchor, d1, d2, hits (a byte for each window, 1 for a repeat), from a run-length index of every shard."""
    total = fetched.agg(F.sum(F.length("content"))).first()[0] or 0
    shards = int(total // SHARD_BYTES) + 1

    def run(table: pa.Table) -> pa.Table:
        hits = [hit.astype(np.uint8).tobytes() for _, hit in judge(table["content"].to_pylist(), table["copies"].to_pylist(), window)]
        return pa.table([*(table[c] for c in CONTENT), pa.array(hits, pa.binary())], names=[*CONTENT, "hits"])

    dealt = fetched.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(run, "anchor long, d1 long, d2 long, hits binary")


def salted_repeats(fetched: DataFrame, sizes: DataFrame, window: Window) -> DataFrame:
    """The same for anchors with very many contents (sizes: anchor, count): they are salted over shards, and windows that a shard
    can't tell are compared across shards by 128-bit hashes.

    Each shard sends the hashes of windows without a match in it, and one of each kind of those with one; rows that
    travel are lists, dealt out by ranges of the hash. A kind that all contents hold is sent once by each shard.
    """
    salted = fetched.join(sizes, "anchor").withColumn("shard", F.pmod(F.xxhash64("d1", "d2"), F.ceil(F.col("count") / HOT)))

    def local(table: pa.Table) -> pa.Table:
        own, sent, hits = set(), [], []
        for s, hit in judge(table["content"].to_pylist(), table["copies"].to_pylist(), window):
            keep = []
            for k in range(len(hit)):
                name = hashlib.blake2b(s[k : k + window.length].tobytes(), digest_size=16).digest()
                if not hit[k]:
                    keep.append(k.to_bytes(2, "little") + name)
                elif name not in own:
                    own.add(name)
                    keep.append(b"\xff\xff" + name)
            hits.append(hit.astype(np.uint8).tobytes())
            sent.append(b"".join(keep))
        return pa.table([*(table[c] for c in CONTENT), pa.array(hits, pa.binary()), pa.array(sent, pa.binary())], names=[*CONTENT, "hits", "sent"])

    told = settle(salted.groupBy("anchor", "shard").applyInArrow(lambda _, t: local(t), "anchor long, d1 long, d2 long, hits binary, sent binary"), "salted")
    buckets = int((told.agg(F.sum(F.length("sent"))).first()[0] or 0) // SHARD_BYTES) + 1
    record = np.dtype([("place", "<u2"), ("w1", "<u8"), ("w2", "<u8")])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i in range(b.num_rows):
                x = np.frombuffer(b.column(3)[i].as_py(), record)
                bucket = (x["w1"] % np.uint64(buckets)).astype(np.int64)
                rows += [(*(b.column(c)[i].as_py() for c in range(3)), int(k), x[bucket == k].tobytes()) for k in np.unique(bucket)]
            cols = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.binary())], names=[*CONTENT, "bucket", "part"])

    def meet(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, record) for x in table["part"].to_pylist()]
        x = np.concatenate(parts)
        _, kind, m = np.unique(np.stack([x["w1"], x["w2"]], 1), axis=0, return_inverse=True, return_counts=True)
        again = (m[kind.ravel()] > 1) & (x["place"] != 0xFFFF)
        edges = np.cumsum([0] + [len(p) for p in parts])
        found = [x["place"][a:z][again[a:z]].astype("<u2").tobytes() for a, z in zip(edges, edges[1:])]
        return pa.table([*(table[c] for c in CONTENT), pa.array(found, pa.binary())], names=[*CONTENT, "found"])

    dealt = told.select(*CONTENT, "sent").mapInArrow(deal, "anchor long, d1 long, d2 long, bucket long, part binary")
    across = dealt.groupBy("bucket").applyInArrow(meet, "anchor long, d1 long, d2 long, found binary").filter(F.length("found") > 0)
    across = across.groupBy(*CONTENT).agg(F.collect_list("found").alias("found"))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for hits, found in zip(b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True):
                x = np.frombuffer(hits, np.uint8).copy()
                for f in found or ():
                    x[np.frombuffer(f, "<u2")] = 1
                out.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(out, pa.binary())], names=[*CONTENT, "hits"])

    return told.select(*CONTENT, "hits").join(across, CONTENT, "left").mapInArrow(add, "anchor long, d1 long, d2 long, hits binary")


def removals(docs: DataFrame, window: Window = BYTES, text: str = "text") -> DataFrame:
    """doc_id, key, spans: of documents with repeats, arrays of (start, end) in symbols, as windows come. Written out."""
    named = name_segments(docs, window, text)
    # a content that occurs several times is a repeat as it is; one that is alone may still repeat itself
    ends = [f(c).alias(n) for c, f, n in (("d1", F.min, "a"), ("d1", F.max, "b"), ("d2", F.min, "c"), ("d2", F.max, "d"))]
    anchors = named.groupBy("anchor").agg(F.count(F.lit(1)).alias("m"), F.bool_or("again").alias("again"), *ends).filter("m > 1 OR again")
    several = (F.col("a") != F.col("b")) | (F.col("c") != F.col("d")) | (F.col("m") == 1)
    # written out, so that both sides of the join are plain exchanges, which AQE can split at a hot anchor
    anchors = settle(anchors.select("anchor", several.alias("several")), "anchors")
    met = settle(named.join(anchors, "anchor"), "segments-met")
    span = lambda start, end: F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"))
    whole = met.filter("not several").select(*ROW, F.array(span(F.col("at"), F.col("at") + F.col("n") + (window.length - 1))).alias("found"))
    found = whole
    mixed = met.filter("several")
    if not mixed.isEmpty():
        contents = mixed.groupBy(*CONTENT).agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "key", "at", "n")).alias("x"))
        contents = settle(contents.select(*CONTENT, "copies", "x.*"), "contents")
        fetched = fetch(docs, contents, window, text)
        hot = settle(contents.groupBy("anchor").count().filter(F.col("count") > HOT), "hot-anchors")
        if hot.isEmpty():
            judged = indexed_repeats(fetched, window)
        else:
            judged = indexed_repeats(fetched.join(hot, "anchor", "left_anti"), window).unionByName(salted_repeats(fetched, hot, window))
        judged = settle(judged, "judged")

        def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                out, keep = [], []
                for i, hits in enumerate(b.column(3)):
                    x = np.frombuffer(hits.as_py(), np.uint8)
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], x, [0])).astype(np.int8)))
                    if len(edge):
                        keep.append(i)
                        out.append([{"s": int(s), "e": int(e)} for s, e in zip(edge[::2], edge[1::2], strict=True)])
                part = b.take(pa.array(keep, pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(out, pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())])))], names=[*CONTENT, "runs"])

        judged = judged.mapInArrow(runs, "anchor long, d1 long, d2 long, runs array<struct<s:int,e:int>>")
        part = F.transform("runs", lambda r: span(F.col("at") + r["s"], F.col("at") + r["e"] + (window.length - 1)))
        found = whole.union(mixed.join(judged, CONTENT).select(*ROW, part.alias("found")))
    return settle(found.groupBy(*ROW).agg(F.flatten(F.collect_list("found")).alias("spans")), "removals")


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def passages(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, key, n_passages, n_passage_words: of documents with words in repeated passages, how many runs of such words, and words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [merged([(x["start"], x["end"]) for x in spans]) for spans in batch.column(2).to_pylist()]
            counts = [pa.array([len(f) for f in found], pa.int64()), pa.array([sum(e - s for s, e in f) for f in found], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *counts], names=[*ROW, "n_passages", "n_passage_words"])

    return removals(docs, WORDS, text).mapInArrow(run, "doc_id long, key long, n_passages long, n_passage_words long")


def cut(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, spans (start and end in bytes) and kept (binary) of every document."""
    return _cut(docs, text, "kept binary", lambda kept: kept, lambda t: F.encode(t, "UTF-8").alias("kept")).drop("key")


def cut_digests(docs: DataFrame, text: str = "text") -> DataFrame:
    """cut() with kept_sha256 in place of kept, and the counts of passages()."""
    found = _cut(docs, text, "kept_sha256 string", lambda kept: hashlib.sha256(kept).hexdigest(), lambda t: F.sha2(F.encode(t, "UTF-8"), 256).alias("kept_sha256"))
    counts = ("n_passages", "n_passage_words")
    held = passages(docs, text).select(F.col("doc_id").alias("__doc"), F.col("key").alias("__key"), *counts)
    joined = found.join(held, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("key") == F.col("__key")), "left")
    return joined.drop("key", "__doc", "__key").withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in counts})


def _cut(docs: DataFrame, text: str, column: str, finish, untouched) -> DataFrame:
    gone = removals(docs, BYTES, text).select(F.col("doc_id").alias("__doc"), F.col("key").alias("__key"), "spans")
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("key") == F.col("__key"))
    kind = pa.binary() if "binary" in column else pa.string()
    spans_kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, key, value, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = value.encode("utf-8", "replace")
                out = merged([(x["start"], x["end"]) for x in spans])
                edges = [0, *(p for x in out for p in x), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                rows.append((doc_id, key, len(raw), len(raw) - len(kept), len(out), [{"start": s, "end": e} for s, e in out], finish(kept)))
            cols = list(zip(*rows, strict=True)) or [()] * 7
            kinds = (*[pa.int64()] * 5, spans_kind, kind)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=[*ROW, "n_bytes", "n_removed", "n_spans", "spans", column.split()[0]])

    schema = f"doc_id long, key long, n_bytes long, n_removed long, n_spans long, spans array<struct<start:int,end:int>>, {column}"
    changed = matching_rows(docs, gone.select(F.col("__key").alias("key")), text).join(gone, same).select(*ROW, "text", "spans").mapInArrow(run, schema)
    own = own_rows(docs, text)
    zero = F.lit(0).cast("long")
    light = own.select(*ROW, F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("spans"), untouched(F.col("text")))
    return light.join(gone.select("__doc", "__key"), same, "left_anti").unionByName(changed)

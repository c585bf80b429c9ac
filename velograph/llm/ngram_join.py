"""Exact Jaccard self-join on word shingles, with prefix filters under several global token orders.

A set's prefix under a global order is its first |A| - ceil(0.75 |A|) + 1 tokens; two sets that are similar enough share a token
of their prefixes under every order. Three orders are used: A by rarity (a count sketch of fixed size over all distinct
sets, then a mixed hash), B by hash ascending and C by hash descending. Order A deals prefix tokens out to buckets, in which
candidates meet if their sizes and the token's places allow a similar pair (a pair's first common token always does); before
verification a pair must also share prefix tokens under B and under C (a sorted set begins and ends
with them). Tokens whose cell of the sketch is far fuller than the mean are hot: their buckets are salted over tasks and passed on
as they are, which costs rows and loses nothing.

Equal sets are one node, so copies never meet as pairs. Buckets with the same members count once. Sets joined by shared
buckets are a family. A small family travels to one task once. There an inverted index of the prefixes under A brings each
set's candidates, B and C cut them down, and only candidates of another component are verified; a bucket whose members are
all in the set's component isn't opened, and no pair is emitted. A large family, such as a third of all documents, stays spread
out: in each of ROUNDS rounds, every set is verified against one set of another component that it shares a bucket with, and
the links are joined to components. After that, in buckets that still hold several components, all sets but those of the
largest one are paired with what their sizes and places allow, so no link that could join two components is lost, and a group
of near copies costs a few pairs for each member.

Texts are scanned and never shuffled. Sets are named by 64-bit digests; verification compares tokens by 48 bits. A null text, or one without words, has no
shingles and no link; with fewer words than a shingle the whole sequence is one token; repeated rows are copies; a null
doc_id is never a component's name; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velograph.llm.components import components
from velograph.llm.shared import bit_table, settle, whole_text
from velograph.llm.words import CHUNK, mixed, word_hashes

WORDS, PERCENT, ROUNDS = 5, 75, 3
SKETCH_BITS, PART, TABLE_BITS = 22, 1 << 15, 24
#: Within buckets of up to so many sets, those without a viable partner are dropped.
SHORT_RUN = 48
#: Families of up to so many tokens (24 MB) and sets are small.
FAMILY_TOKENS, FAMILY_SETS = 4_000_000, 4096
#: Tokens of the small families that one task gets, on the average.
GROUP_TOKENS = 1_000_000
#: A bucket of more sets is passed on in parts.
LONG_RUN = 1 << 20
#: Tokens of cells with so many counts, and HOT_TIMES the mean, are dealt out by SALTS parts.
HOT_RUN, HOT_TIMES, SALTS = 512, 16, 64

_U = np.uint64
PLACE = mixed(np.arange(1001, 1001 + WORDS, dtype=_U)) | _U(1)


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Of each text the sorted distinct hashes of its shingles."""
    out: list[np.ndarray] = []
    block: list[bytes] = []

    def flush() -> None:
        lengths = np.array([len(x) + 1 for x in block])
        words, starts = word_hashes(b"\n".join(block))
        first = np.searchsorted(starts, np.concatenate(([0], np.cumsum(lengths))))
        n = max(len(words) - WORDS + 1, 0)
        grams = np.zeros(n, _U)
        for k in range(WORDS):
            grams += words[k : k + n] * PLACE[k]
        grams = mixed(grams)
        for i in range(len(block)):
            a, z = first[i], first[i + 1]
            if z - a >= WORDS:
                out.append(np.unique(grams[a : z - WORDS + 1]))
            elif z > a:
                out.append(mixed(np.sum(words[a:z] * PLACE[: z - a], dtype=_U, keepdims=True) + _U(z - a)))
            else:
                out.append(np.zeros(0, _U))
        block.clear()

    size = 0
    for t in texts:
        block.append(t.encode("utf-8", "replace"))
        size += len(block[-1])
        if size >= CHUNK:
            flush()
            size = 0
    if block:
        flush()
    return out


def set_id(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def prefix_length(n):
    return n - (PERCENT * n + 99) // 100 + 1


def pack(tokens: np.ndarray) -> bytes:
    """The upper 48 bits of each token, in order: what verification compares."""
    return (tokens >> _U(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Prefix filters under orders B and C, then the exact test."""
    n, m = len(a), len(b)
    if 100 * min(n, m) < PERCENT * max(n, m):
        return False
    p, q = prefix_length(n), prefix_length(m)
    if not shared(a[:p], b[:q]) or not shared(a[n - p :], b[m - q :]):
        return False
    both = shared(a, b)
    return 100 * both >= PERCENT * (n + m - both)


def shared(a: np.ndarray, b: np.ndarray) -> int:
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def _chunks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[str]]]:
    """Rows of a batch in runs of about 4 MB of text."""
    start, size, held = 0, 0, []
    for i, v in enumerate(batch.column(column)):
        held.append(v.as_py())
        size += len(held[-1])
        if size >= 4 * CHUNK:
            yield start, held
            start, size, held = i + 1, 0, []
    if held:
        yield start, held


def name_sets(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, key, n_shingles, sid) of every document: key is a hash of the text, sid is null without shingles. Written out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sid = [], []
            for _, texts in _chunks(batch, 2):
                for s in shingle_sets(texts):
                    n.append(len(s))
                    sid.append(set_id(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(n, pa.int64()), pa.array(sid, pa.int64())], names=["doc_id", "key", "n_shingles", "sid"])

    own = docs.select(F.col("doc_id").cast("long"), F.xxhash64(whole_text(text)).alias("key"), whole_text(text).alias("text"))
    return settle(own.mapInArrow(run, "doc_id long, key long, n_shingles long, sid long"), "ngram-sets")


def sketch(docs: DataFrame, text: str = "text") -> np.ndarray:
    """How many tokens of distinct sets (distinct within a task) fall into each of 2^SKETCH_BITS cells, as steps of half a
    power of two. Tasks send their counts in parts of PART cells; 4 MB reach the driver, whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(1 << SKETCH_BITS, np.int32), set()
        for batch in batches:
            for _, texts in _chunks(batch, 0):
                fresh = []
                for s in shingle_sets(texts):
                    sid = set_id(s)
                    if len(s) and sid not in seen:
                        seen.add(sid)
                        fresh.append(s)
                if fresh:
                    cells, n = np.unique(np.concatenate(fresh) >> _U(64 - SKETCH_BITS), return_counts=True)
                    total[cells.astype(np.int64)] += n.astype(np.int32)
        parts = np.minimum(total, 0xFFFF).astype("<u2").reshape(-1, PART)
        full = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([parts[i].tobytes() for i in full], pa.binary())], names=["part", "counts"])

    def add(t: pa.Table) -> pa.Table:
        total = np.zeros(PART, np.int64)
        for x in t["counts"].to_pylist():
            total += np.frombuffer(x, "<u2")
        return pa.table([t["part"][:1], pa.array([np.floor(np.log2(np.maximum(total, 1)) * 2).astype(np.uint8).tobytes()], pa.binary())], names=["part", "steps"])

    out = np.zeros((1 << SKETCH_BITS) // PART * PART, np.uint8).reshape(-1, PART)
    counts = docs.select(whole_text(text)).mapInArrow(run, "part int, counts binary")
    for r in counts.groupBy("part").applyInArrow(add, "part int, steps binary").toLocalIterator():
        out[r["part"]] = np.frombuffer(r["steps"], np.uint8)
    return out.ravel()


def rarity_keys(tokens: np.ndarray, cells: np.ndarray, rare: np.ndarray) -> np.ndarray:
    """Keys in order A: the step of a token's cell, then a hash of it."""
    return (rare[cells.astype(np.int64)].astype(_U) << _U(56)) | (mixed(tokens) >> _U(8))


def hot_step(rare: np.ndarray) -> int:
    """The step from which a cell's tokens are hot."""
    mean = float(np.exp2(rare / 2).mean())
    return int(np.ceil(2 * np.log2(max(HOT_RUN, HOT_TIMES * mean))))


def postings(docs: DataFrame, rarity: np.ndarray, text: str = "text") -> DataFrame:
    """(token, sid, n, i): prefix tokens under order A, as their keys in that order, with their places; a set that a task has
    met before is skipped."""
    held = docs.sparkSession.sparkContext.broadcast(rarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare, seen = held.value, set()
        for batch in batches:
            for _, texts in _chunks(batch, 0):
                tokens, sids, sizes, counts, at = [], [], [], [], []
                for s in shingle_sets(texts):
                    if not len(s) or (sid := set_id(s)) in seen:
                        continue
                    seen.add(sid)
                    p = prefix_length(len(s))
                    order = rarity_keys(s, s >> _U(64 - SKETCH_BITS), rare)
                    tokens.append(np.sort(np.partition(order, p - 1)[:p]))
                    at.append(np.arange(p, dtype=np.int32))
                    sids.append(sid)
                    sizes.append(len(s))
                    counts.append(p)
                if tokens:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.repeat(np.array(sids, np.int64), counts)), pa.array(np.repeat(np.array(sizes, np.int32), counts)), pa.array(np.concatenate(at))], names=["token", "sid", "n", "i"])

    return docs.select(whole_text(text)).mapInArrow(run, "token long, sid long, n int, i int")


def viable(n, i, m, j, least=np.minimum):
    """Whether sets of n and m tokens whose first common token stands at i and j may be similar: works on columns, too."""
    return (100 * least(n, m) >= PERCENT * (n + m - least(n, m))) & ((100 + PERCENT) * least(n - i, m - j) >= PERCENT * (n + m))


def partnered(token: np.ndarray, n: np.ndarray, i: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Of each posting, whether any other of its run is viable with it; runs longer than SHORT_RUN are let through."""
    n, i = n.astype(np.int64), i.astype(np.int64)
    own = np.repeat(length, length)
    ok = own > SHORT_RUN
    for k in range(1, min(SHORT_RUN, int(length.max(initial=1)))):
        at = np.flatnonzero((token[k:] == token[:-k]) & (own[k:] <= SHORT_RUN))
        at = at[viable(n[at], i[at], n[at + k], i[at + k])]
        ok[at] = ok[at + k] = True
    return ok


def buckets(posted: DataFrame, hot: int = 256) -> DataFrame:
    """Postings of tokens that two viable sets or more share, the first token for each list of members. Written out.

    Rows come sorted by token, so a task holds one run at most beside its batch. A run that is passed on in parts, and that of a
    token from the step hot on, is neither pruned nor named by its members, as no part tells what the others hold.
    """
    names = ["token", "sid", "n", "i"]

    def in_parts(token: np.ndarray, parted: list[int]) -> np.ndarray:
        return np.isin(token, parted) | ((token.view(_U) >> _U(56)).astype(np.int64) >= hot)

    def judged(cols: list[np.ndarray], known: set[int], parted: list[int]) -> pa.RecordBatch | None:
        fresh = np.ones(len(cols[0]), bool)
        fresh[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])
        cols = [c[fresh] for c in cols]  # a set that several tasks have posted
        for turn in range(2):  # runs, then runs of what is left
            token = cols[0]
            if not len(token):
                return None
            starts = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
            length = np.diff(np.append(starts, len(token)))
            if turn == 0:
                keep = partnered(token, cols[2], cols[3], length) | in_parts(token, parted)
                cols = [c[keep] for c in cols]
        sig = np.add.reduceat(mixed(cols[1].view(_U)), starts) ^ mixed(length.astype(_U))
        good = in_parts(token[starts], parted)
        sig[good] = mixed(~mixed(token[starts][good].view(_U)))
        for r, key in enumerate(sig.tolist()):
            if key not in known:
                if len(known) > 2_000_000:
                    known.clear()
                known.add(key)
                good[r] = True
        take = np.repeat(good, length)
        return pa.RecordBatch.from_arrays([*(pa.array(c[take]) for c in cols), pa.array(np.repeat(sig, length)[take].view(np.int64))], names=[*names, "sig"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, known = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)], set()
        parted: list[int] = []  # the last tokens whose runs were passed on in parts
        for b in batches:
            cols = [np.concatenate((r, np.asarray(b.column(k)))) for k, r in enumerate(rest)]
            # the last run may go on in the next batch; a very long one is passed on in parts
            cut = int(np.searchsorted(cols[0], cols[0][-1])) if len(cols[0]) else 0
            if len(cols[0]) - cut > LONG_RUN:
                parted, cut = [*parted[-1:], int(cols[0][-1])], len(cols[0])
            rest = [c[cut:] for c in cols]
            out = judged([c[:cut] for c in cols], known, parted)
            if out is not None:
                yield out
        out = judged(rest, known, parted)
        if out is not None:
            yield out

    n = posted.sparkSession.conf.get("spark.sql.shuffle.partitions")
    salt = F.when(F.shiftrightunsigned("token", 56) >= hot, F.pmod(F.xxhash64("sid"), F.lit(SALTS))).otherwise(F.lit(0).cast("long"))
    local = posted.repartition(int(n), "token", salt).sortWithinPartitions("token", "sid").mapInArrow(run, "token long, sid long, n int, i int, sig long")
    local = settle(local, "ngram-local")
    first = local.groupBy("sig").agg(F.min("token").alias("first")).select("first").distinct()
    return settle(local.join(first, F.col("token") == F.col("first"), "left_semi").select(*names).distinct(), "ngram-buckets")


def fetch_sets(docs: DataFrame, wanted: DataFrame, text: str = "text") -> DataFrame:
    """(sid, tokens binary, and wanted's other columns) of the sets that wanted (sid, one row each) names; not yet written out."""
    held = docs.sparkSession.sparkContext.broadcast(bit_table(wanted, F.col("sid"), TABLE_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = np.frombuffer(held.value, np.int64), set()
        for batch in batches:
            for _, texts in _chunks(batch, 0):
                sids, sets = [], []
                for s in shingle_sets(texts):
                    if not len(s) or (sid := set_id(s)) in seen:
                        continue
                    at = sid & ((1 << TABLE_BITS) - 1)
                    if (int(bits[at >> 6]) >> (at & 63)) & 1:
                        seen.add(sid)
                        sids.append(sid)
                        sets.append(pack(s))
                if sids:
                    yield pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()), pa.array(sets, pa.binary())], names=["sid", "tokens"])

    found = docs.select(whole_text(text)).mapInArrow(run, "sid long, tokens binary")
    # copies met by several tasks are alike; which of them stays makes no difference
    return found.join(wanted, "sid").dropDuplicates(["sid"])


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar. Written out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [similar(unpack(x.as_py()), unpack(y.as_py())) for x, y in zip(b.column(2), b.column(3), strict=True)]
            yield b.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    left = sets.select(F.col("sid").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("sid").alias("b"), F.col("tokens").alias("tb"))
    return settle(pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long"), "ngram-links")


def _labelled(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return rows.withColumn("root", F.col("sid"))
    return rows.join(roots, F.col("sid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "sid")).drop("node")


def _open(rows: DataFrame) -> DataFrame:
    """Buckets that still hold two components or more."""
    mixed_up = rows.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("token")
    return rows.join(settle(mixed_up, "ngram-mixed"), "token", "left_semi")


def families(bucket: DataFrame) -> DataFrame:
    """(sid, family, group): sets joined by shared buckets, and the task group of a small family, null for a large one. Written out."""
    hub = settle(bucket.groupBy("token").agg(F.min("sid").alias("b")), "ngram-hubs")  # a plain side of the join: AQE can split a hot token
    edges = bucket.join(hub, "token").select(F.col("sid").alias("a"), "b")
    sets = bucket.groupBy("sid").agg(F.max("n").cast("long").alias("n"))
    named = _labelled(sets, components(edges)).withColumnRenamed("root", "family")
    size = named.groupBy(F.col("family").alias("f")).agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("members"))
    small = (F.col("tokens") <= FAMILY_TOKENS) & (F.col("members") <= FAMILY_SETS)
    total = named.agg(F.sum("n")).first()[0] or 0
    group = F.when(small, F.pmod(F.xxhash64("family"), F.lit(int(total // GROUP_TOKENS) + 1)))
    return settle(named.join(size, F.col("family") == F.col("f")).select("sid", "family", group.alias("group")), "ngram-families")


def link_members(family: np.ndarray, sets: list[np.ndarray], rare: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (earlier, later) of similar sets that join the components of each family; members of a family stand together.

    An inverted index of the sets' prefixes under A: runs of entries with one family and key, in order of their sets.
    """
    n = np.array([len(s) for s in sets], np.int64)
    p = prefix_length(n)
    keys = []
    for s, k in zip(sets, p.tolist(), strict=True):
        order = rarity_keys(s, s >> _U(48 - SKETCH_BITS), rare)
        keys.append(np.sort(np.partition(order, k - 1)[:k]))
    owner, place = np.repeat(np.arange(len(sets)), p), np.concatenate([np.arange(k) for k in p.tolist()])
    keys = np.concatenate(keys)
    order = np.lexsort((owner, keys, family[owner]))
    owner, place, keys = owner[order], place[order], keys[order]
    fresh = np.concatenate(([True], (keys[1:] != keys[:-1]) | (family[owner[1:]] != family[owner[:-1]])))
    start = np.flatnonzero(fresh)
    run = np.cumsum(fresh) - 1
    held, mixed_up = owner[start], np.zeros(len(start), bool)
    entries, ends = np.argsort(owner, kind="stable"), np.cumsum(p)
    first = np.searchsorted(family, family)
    label, out = np.arange(len(sets)), []

    def link(x: int, found: np.ndarray) -> None:
        """Verify x against those found that are of other components, the most often found first."""
        found, times = np.unique(found, return_counts=True)
        found = found[np.argsort(-times, kind="stable")]
        found = found[label[found] != label[x]]
        while len(found):
            y = int(found[0])
            if similar(sets[x], sets[y]):
                out.append((y, x))
                part = label[first[x] : x + 1]
                part[part == max(label[x], label[y])] = min(label[x], label[y])
                found = found[label[found] != label[x]]
            else:
                found = found[1:]

    for x in range(len(sets)):
        at = entries[ends[x] - p[x] : ends[x]]
        at = at[at > start[run[at]]]
        if not len(at):
            continue
        link(x, owner[at - 1])
        shut = ~mixed_up[run[at]] & (label[held[run[at]]] == label[x])
        if not shut.all():
            ours = at[~shut]
            begin = start[run[ours]]
            length = ours - begin
            each = np.repeat(np.arange(len(ours)), length)
            there = begin[each] + np.arange(len(each)) - np.repeat(np.cumsum(length) - length, length)
            fits = viable(n[x], place[ours][each], n[owner[there]], place[there])
            link(x, owner[there[fits]])
            mixed_up[run[ours]] |= label[held[run[ours]]] != label[x]
    return out


def link_families(sets: DataFrame, rarity: np.ndarray) -> DataFrame:
    """Links (a, b) that join the components of small families; sets: sid, tokens, family, group. Written out."""
    held = sets.sparkSession.sparkContext.broadcast(rarity)

    def run(table: pa.Table) -> pa.Table:
        order = table.sort_by([("family", "ascending"), ("sid", "ascending")])
        sid = np.asarray(order["sid"])
        _, family = np.unique(np.asarray(order["family"]), return_inverse=True)
        pairs = np.array(link_members(family, [unpack(x) for x in order["tokens"].to_pylist()], held.value), np.int64).reshape(-1, 2)
        return pa.table([pa.array(sid[pairs[:, k]], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return settle(sets.groupBy("group").applyInArrow(run, "a long, b long"), "ngram-links")


def link_hubs(bucket: DataFrame, sets: DataFrame) -> DataFrame:
    """The same for large families: rounds of one pair for each set, then, in buckets that still hold several components, all sets
    but those of the largest one against what is viable. The sides of that join are written out, so that AQE can split a hot token."""
    spark = bucket.sparkSession
    links, tried, roots = spark.createDataFrame([], "a long, b long"), spark.createDataFrame([], "a long, b long"), None
    fits = lambda *x: viable(*(F.col(c).cast("long") for c in x), least=F.least)
    for turn in range(ROUNDS + 1):
        bucket = settle(_open(_labelled(bucket.select("token", "sid", "n", "i"), roots)), "ngram-open")
        if bucket.isEmpty():
            break
        if turn < ROUNDS:
            place = F.col("sid") if turn == 0 else F.xxhash64("sid", F.lit(turn))
            hubs = bucket.groupBy("token").agg(F.min(F.struct(place.alias("p"), "sid", "root", "n", "i")).alias("hub"))
            met = bucket.join(settle(hubs, "ngram-hubs"), "token").filter((F.col("root") != F.col("hub.root")) & fits("n", "i", "hub.n", "hub.i"))
            pairs = met.groupBy("sid").agg(F.min("hub").alias("hub")).select(F.least("sid", "hub.sid").alias("a"), F.greatest("sid", "hub.sid").alias("b"))
        else:
            sizes = bucket.groupBy("token", "root").agg(F.count(F.lit(1)).alias("m"))
            main = settle(sizes.groupBy("token").agg(F.max_by("root", F.struct("m", "root")).alias("main")), "ngram-main")
            minor = settle(bucket.join(main, "token").filter("root <> main").drop("main"), "ngram-minor")
            other = bucket.select("token", F.col("sid").alias("sid2"), F.col("n").alias("n2"), F.col("i").alias("i2"), F.col("root").alias("root2"))
            met = minor.join(other, "token").filter((F.col("root") != F.col("root2")) & fits("n", "i", "n2", "i2"))
            pairs = met.select(F.least("sid", "sid2").alias("a"), F.greatest("sid", "sid2").alias("b"))
        fresh = settle(pairs.distinct().join(tried, ["a", "b"], "left_anti"), "ngram-pairs")
        tried = tried.union(fresh)
        links = links.union(verify(fresh, sets))
        roots = components(links)
    return links


def link(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """name_sets(docs), verified links (a, b) that join the components of sets, and (node, root) of sets in a component of several."""
    named = name_sets(docs, text)
    rarity = sketch(docs, text)
    bucket = buckets(postings(docs, rarity, text), hot_step(rarity))
    if bucket.isEmpty():
        return named, docs.sparkSession.createDataFrame([], "a long, b long"), None
    family = families(bucket)
    links = link_families(fetch_sets(docs, family.filter("group IS NOT NULL"), text), rarity)
    large = family.filter("group IS NULL").select("sid")
    if not large.isEmpty():
        sets = settle(fetch_sets(docs, large, text), "ngram-tokens")
        links = links.union(link_hubs(bucket.join(large, "sid", "left_semi"), sets))
    return named, links, components(links)


def classes(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, key, n_shingles, sid, root (null without shingles), component_id: the least doc_id reachable by links, itself included."""
    named, _, roots = link(docs, text)
    rooted = _labelled(named, roots)
    least = settle(rooted.filter("sid IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least")).withColumnRenamed("root", "__root"), "ngram-least")
    out = rooted.join(least, F.col("root") == F.col("__root"), "left")
    return out.select("doc_id", "key", "n_shingles", "sid", "root", F.coalesce("least", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with one document of each component: that of the least (doc_id, key), nulls first. Documents without shingles
    stay; of rows equal in doc_id and text, that whose other columns come first as JSON."""
    found = settle(classes(docs, text), "ngram-classes")
    first = found.filter("root IS NOT NULL").groupBy("root").agg(F.min(F.struct("doc_id", "key")).alias("k")).select("k.doc_id", "k.key")
    stay = first.union(found.filter("root IS NULL").select("doc_id", "key")).distinct().select(F.col("doc_id").alias("__doc"), F.col("key").alias("__key"))
    # the row travels as one column, so that no other name can clash with its own
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(whole_text(text)).alias("own"))
    kept = keyed.join(settle(stay, "ngram-stay"), F.col("id").eqNullSafe(F.col("__doc")) & (F.col("own") == F.col("__key")), "left_semi")
    if not found.groupBy("doc_id", "key").count().filter("count > 1").isEmpty():
        rest = F.to_json(F.struct(*[F.col("row")[c].alias(c) for c in docs.columns if c != text]), {"ignoreNullFields": "false"})
        kept = kept.groupBy("id", "own").agg(F.min_by("row", rest).alias("row"))
    return kept.select("row.*")

"""Near-duplicates by ProbMinHash: signatures of weighted word shingles, banding, verification, components.

Words are those of decontamination (A-Z lower-cased); a shingle is five consecutive words, weighted by its count in the
text; a text of one to four words has one shingle. The similarity of two texts is the probability Jaccard
sum over common d of 1 / sum over e of max(x[e] / x[d], y[e] / y[d]), which is the Jaccard similarity where all weights
are one. Texts of similarity 0.8 or more are linked; a class is a component of links and equal texts.

Signatures: every shingle sends points to random registers as a Poisson process whose rate is its weight; a register
keeps the shingle of its first point. Points are made up to a horizon by which the registers are full with high
probability; texts whose registers are not full get twice the horizon, so the early end changes nothing. 160 registers
in 32 bands of five: a link of similarity 0.8 meets in no band with probability 3e-6.

Links of buckets, without all pairs: equal texts are one node first. Members of a bucket are verified against one hub
of it, and components are formed. Only buckets that still hold several components are compared further, text by text within tasks
and in blocks of bounded size; what comes out are the links that join components, fewer than there are components. A
link within a component adds nothing to the classes.

Defined cases: equal texts, empty ones too, are one class; texts without words are similar to no other; a null text is a
class of its own; class_id is the least doc_id of a class; of repeated rows one is kept; a class without any doc_id has a
null class_id; an empty table gives an empty result; columns that have the name of an output give way to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .store import checkpointed, written
from .text import ALNUM, LOWER_CODES, SMALL_SLICE_BYTES, flat, gram_hashes, inside_one, mix, slices, span_hashes, spans, without

WIDTH = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 5
REGISTERS = BANDS * ROWS
#: Members of a bucket, and bytes of their texts, that one task compares with as many others at once.
BLOCK = 2048
BLOCK_BYTES = 1 << 22
#: Texts whose points are drawn at once: each has some 1,300, however short it is.
DRAWN = 128
#: Rows (node and text key) of the set of texts to verify that may be broadcast, 40 MB at most.
BROADCAST_TEXTS = 500_000
_OUTPUTS = ("class_id", "class_size", "kept")

_STEP = np.uint64(0x9E3779B97F4A7C15)
_REGISTER = np.uint64(0xC2B2AE3D27D4EB4F)


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """owner, hash and count of each distinct shingle of each text, in the order of owner."""
    data, offsets = flat(texts)
    starts, ends, counts = spans(data, offsets, ALNUM)
    words = span_hashes(data, starts, ends, LOWER_CODES)
    owner = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero(inside_one(counts, WIDTH))
    grams, owners = [gram_hashes(words, WIDTH)[at]], [owner[at]]
    firsts = np.cumsum(counts) - counts
    for n in range(1, WIDTH):
        short = np.flatnonzero(counts == n)
        if len(short):
            grams.append(gram_hashes(words, n)[firsts[short]])
            owners.append(short)
    gram, own = np.concatenate(grams), np.concatenate(owners)
    order = np.lexsort((gram, own))
    gram, own = gram[order], own[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (own[1:] != own[:-1])
    first = np.flatnonzero(new)
    return own[first], gram[first], np.diff(np.append(first, len(gram)))


def _points(owner, gram, weight, horizon, block: int):
    """All points (text, register, time, shingle) up to each text's horizon."""
    found = []
    k = 0
    clock = np.zeros(len(gram))
    alive = np.arange(len(gram))
    while len(alive):
        steps = np.arange(k + 1, k + block + 1, dtype=np.uint64)
        seed = mix(gram[alive][:, None] + steps * _STEP)
        u = ((seed >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52
        times = clock[alive][:, None] + np.cumsum(-np.log(u) / weight[alive][:, None], axis=1)
        inside = times <= horizon[owner[alive]][:, None]
        row, col = np.nonzero(inside)
        register = ((mix(seed[row, col] + _REGISTER) >> np.uint64(32)) * np.uint64(REGISTERS)) >> np.uint64(32)
        found.append((owner[alive[row]] * REGISTERS + register.astype(np.int64), times[row, col], gram[alive[row]]))
        clock[alive] = times[:, -1]
        alive = alive[inside[:, -1]]
        k += block
    return [np.concatenate(x) for x in zip(*found, strict=True)]


def signatures(owner: np.ndarray, gram: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    """ProbMinHash signature of each of n texts that have shingles; rows of the others stay zero. owner rises."""
    out = np.zeros((n, REGISTERS), np.uint64)
    for low in range(0, n, DRAWN):
        own = slice(*np.searchsorted(owner, [low, low + DRAWN]))
        out[low : low + DRAWN] = _drawn(owner[own] - low, gram[own], count[own], min(DRAWN, n - low))
    return out


def _drawn(owner: np.ndarray, gram: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    """The signatures of a few texts."""
    out = np.zeros((n, REGISTERS), np.uint64)
    weight = count.astype(np.float64)
    total = np.bincount(owner, weight, minlength=n)
    open_ = np.flatnonzero(total > 0)
    reach = REGISTERS * (np.log(REGISTERS) + 3)
    while len(open_):
        horizon = np.zeros(n)
        horizon[open_] = reach / total[open_]
        best = np.full(n * REGISTERS, np.inf)
        mine = np.zeros(n * REGISTERS, np.uint64)
        some = np.isin(owner, open_) if len(open_) < n else np.ones(len(owner), bool)
        few = total[owner] < 2 * REGISTERS
        for part, block in ((some & ~few, 2), (some & few, 32)):
            if part.any():
                where, when, what = _points(owner[part], gram[part], weight[part], horizon, block)
                np.minimum.at(best, where, when)
                won = when == best[where]
                mine[where[won]] = what[won]
        full = open_[np.isfinite(best.reshape(n, REGISTERS)[open_]).all(axis=1)]
        out[full] = mine.reshape(n, REGISTERS)[full]
        open_ = np.setdiff1d(open_, full)
        reach *= 2
    return out


def _sketcher(text: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, SMALL_SLICE_BYTES):
            n = batch.num_rows
            owner, gram, count = shingles(batch.column(text))
            drawn = signatures(owner, gram, count, n)
            has = np.zeros(n, bool)
            has[owner] = True
            keys = np.zeros((n, BANDS), np.uint64)
            for k in range(ROWS):
                keys = mix(keys * _STEP + drawn[:, k::ROWS])
            keys = mix(keys + np.arange(BANDS, dtype=np.uint64) * _REGISTER).view(np.int64)
            ends = np.concatenate([[0], np.cumsum(has * BANDS)]).astype(np.int32)
            _, offsets = flat(batch.column(text))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    batch.column("digest"),
                    pa.ListArray.from_arrays(ends, pa.array(keys[has].ravel())),
                    pa.array(np.diff(offsets)),
                ],
                names=["doc", "digest", "bands", "size"],
            )

    return work


def similarities(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Probability Jaccard of each pair of texts; 0 where one has no shingle."""
    n = len(left)
    (oa, ga, ca), (ob, gb, cb) = shingles(left), shingles(right)
    owner, gram = np.concatenate([oa, ob]), np.concatenate([ga, gb])
    order = np.lexsort((gram, owner))
    owner, gram = owner[order], gram[order]
    x = np.concatenate([ca, np.zeros_like(cb)])[order].astype(np.float64)
    y = np.concatenate([np.zeros_like(ca), cb])[order].astype(np.float64)
    twin = np.flatnonzero((gram[1:] == gram[:-1]) & (owner[1:] == owner[:-1]))
    y[twin] += y[twin + 1]
    x[twin] += x[twin + 1]
    keep = np.ones(len(gram), bool)
    keep[twin + 1] = False
    owner, x, y = owner[keep], x[keep], y[keep]
    union, common = np.bincount(owner, minlength=n), np.bincount(owner[(x > 0) & (y > 0)], minlength=n)
    out = common / np.maximum(union, 1)
    heavy = np.unique(owner[(x > 1) | (y > 1)])
    if len(heavy):
        of = np.isin(owner, heavy)
        owner, x, y = owner[of], x[of], y[of]
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(x > 0, y / x, np.inf)
        order = np.lexsort((ratio, owner))
        owner, x, y, ratio = owner[order], x[order], y[order], ratio[order]
        change = np.ones(len(owner), bool)
        change[1:] = (owner[1:] != owner[:-1]) | (ratio[1:] != ratio[:-1])
        last = np.append(np.flatnonzero(change)[1:], len(owner)) - 1
        last = last[np.cumsum(change) - 1]  # where each entry's equal ratios end
        xs, ys = np.cumsum(x), np.cumsum(y)
        begin = np.searchsorted(owner, np.arange(n))
        end = np.searchsorted(owner, np.arange(n), "right")
        x0 = np.append(0, xs)[begin][owner]
        y1 = np.append(0, ys)[end][owner]
        both = (x > 0) & (y > 0)
        below, above = (xs[last] - x0)[both], (y1 - ys[last])[both]
        sums = np.bincount(owner[both], 1 / (below / x[both] + above / y[both]), minlength=n)
        out[heavy] = sums[heavy]
    return out


def _verifier(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for half in slices(batches, "text_a", SMALL_SLICE_BYTES):
        for batch in slices([half], "text_b", SMALL_SLICE_BYTES):
            sims = similarities(batch.column("text_a"), batch.column("text_b"))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(sims)], names=["a", "b", "similarity"])


def _texts_of(nodes: DataFrame, texts: DataFrame, reps: DataFrame, purpose: str) -> DataFrame:
    """(node, text) of some nodes. Copies of a text are aggregated before they move, so a task sends each once."""
    wanted = written(reps.join(nodes, "node", "left_semi").select("node", "digest"), purpose)
    if wanted.count() <= BROADCAST_TEXTS:
        wanted = F.broadcast(wanted)
    return texts.join(wanted, "digest").groupBy("node").agg(F.first("text").alias("text"))


def _verified(pairs: DataFrame, texts: DataFrame, reps: DataFrame, purpose: str) -> DataFrame:
    """(a, b, similarity) of each pair of nodes, from whole texts; written."""
    ends = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct()
    held = _texts_of(ends, texts, reps, f"{purpose}-wanted")
    one = held.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    two = held.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(one, "a").join(two, "b")
    return written(both.select("a", "b", "text_a", "text_b").mapInArrow(_verifier, "a long, b long, similarity double"), purpose)


def _weighted(x: np.ndarray, y: np.ndarray, sizes: np.ndarray, total: float) -> np.ndarray:
    """Probability Jaccard of several texts with one other, a few sums for each ratio of counts that occurs.

    x are the counts of the texts' shingles, text by text, `sizes` of each; y the other's counts of the same
    shingles, and total the sum of all its counts.
    """
    starts = np.cumsum(sizes) - sizes
    ratio = y / x
    out = np.zeros(len(sizes))
    for r in np.unique(ratio[ratio > 0]):
        below = ratio <= r
        mine = np.add.reduceat(np.where(below, x, 0), starts)
        other = total - np.add.reduceat(np.where(below, y, 0), starts)
        out += np.add.reduceat(np.where(ratio == r, x, 0), starts) / (mine + other / r)
    return out


def _compare(table: pa.Table) -> pa.Table:
    """Links that join different components of one bucket, or of two blocks of it; at most one less than components.

    With p and q the shares of a text's shingles, sum of min(p, q) bounds the similarity from above. Texts beyond the
    bound are compared exactly: by their common shingles where all counts are one, else by the whole formula.
    """
    node, label = (table.column(c).to_numpy() for c in ("node", "label"))
    side, low, high = (table.column(c).to_numpy() for c in ("block", "low", "high"))
    texts = pa.chunked_array(table.column("text").chunks, pa.string()).combine_chunks()
    owner, gram, count = shingles(texts)
    _, ids = np.unique(gram, return_inverse=True)
    firsts = np.searchsorted(owner, np.arange(len(node)))
    sizes = np.diff(np.append(firsts, len(owner)))
    total = np.bincount(owner, count, minlength=len(node))
    plain = total == sizes
    share = count / total[owner]
    group = np.unique(label, return_inverse=True)[1]
    left, right = np.flatnonzero(side == low), np.flatnonzero(side == high)
    a, b = [], []
    mark = np.zeros(int(ids.max()) + 1 if len(ids) else 1)
    counts = np.zeros(len(mark))
    for i in left.tolist():
        other = group[right] != group[i]
        if not other.any():
            continue
        own = slice(firsts[i], firsts[i] + sizes[i])
        mark[ids[own]] = share[own]
        most = np.add.reduceat(np.minimum(mark[ids], share), firsts)
        mark[ids[own]] = 0
        to = right[other & (most[right] >= SIMILARITY - 1e-9)]
        both = plain[to] & plain[i]
        common = np.rint(most[to] * np.maximum(sizes[to], sizes[i]))
        sure = both & (common >= SIMILARITY * (sizes[to] + sizes[i] - common))
        rest = np.flatnonzero(~both)
        if len(rest):
            picked = np.concatenate([np.arange(firsts[j], firsts[j] + sizes[j]) for j in to[rest].tolist()])
            counts[ids[own]] = count[own]
            sure[rest] = _weighted(count[picked], counts[ids[picked]], sizes[to[rest]], total[i]) >= SIMILARITY
            counts[ids[own]] = 0
        for j in to[sure].tolist():
            if group[j] != group[i]:
                a.append(node[i])
                b.append(node[j])
                group[group == group[j]] = group[i]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels after further links (a, b) of nodes."""
    for end in ("a", "b"):
        links = links.join(labels.select(F.col("node").alias(end), "label"), end, "left").withColumn(end, F.coalesce("label", end)).drop("label")
    joined = checkpointed(components(links.select("a", "b")).select(F.col("node").alias("label"), F.col("label").alias("joined")))
    grouped = labels.join(joined, "label", "left").select("node", F.coalesce("joined", "label").alias("label"))
    alone = joined.join(labels.select("label").distinct(), "label", "left_anti").select(F.col("label").alias("node"), F.col("joined").alias("label"))
    return checkpointed(grouped.unionAll(alone))


def find_classes(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each row of docs: the key, digest (16 bytes, null for a null text), class_id, class_size and kept."""
    texts = docs.select(F.unhex(F.md5(F.col(text).cast("binary"))).alias("digest"), F.col(text).alias("text"))
    rows = docs.select(F.col(key).alias("doc"), F.unhex(F.md5(F.col(text).cast("binary"))).alias("digest"), F.col(text).alias("text"))
    sketched = rows.mapInArrow(_sketcher("text"), f"doc {docs.schema[key].dataType.simpleString()}, digest binary, bands array<bigint>, size long")
    sketches = written(sketched.withColumn("row", F.monotonically_increasing_id()), "sketches")
    # Equal texts are one node: the first row of them.
    nodes = written(sketches.where("digest is not null").groupBy("digest").agg(F.min("row").alias("node")), "nodes")
    reps = sketches.join(nodes.select(F.col("node").alias("row")), "row", "left_semi").withColumnRenamed("row", "node")
    banded = reps.select("node", "size", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("far")).where("hub < far").select("band", "hub")
    members = written(banded.join(buckets, "band"), "members")
    pairs = written(members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    stars = _verified(pairs, texts, reps, "stars")
    labels = checkpointed(components(stars.where(F.col("similarity") >= SIMILARITY)))
    # Buckets that still hold several components are compared text by text, in blocks; only joining links come out.
    labelled = members.select("band", "node", "size").join(labels, "node", "left").select("band", "node", "size", F.coalesce("label", "node").alias("label"))
    split = labelled.groupBy("band").agg(F.min("label").alias("l"), F.max("label").alias("h"), F.count("*").alias("n"), F.sum("size").alias("size")).where("l < h")
    split = split.select("band", F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("size") / BLOCK_BYTES)).cast("int").alias("blocks"))
    open_ = written(labelled.drop("size").join(split, "band"), "open")
    held = _texts_of(open_.select("node").distinct(), texts, reps, "open-wanted")
    spread = open_.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = spread.select("band", "node", "label", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    found = spread.join(held, "node").groupBy("band", "low", "high").applyInArrow(_compare, "a long, b long")
    found = written(found.distinct(), "links")
    if found.limit(1).count():
        labels = _merged(labels, found)
    owned = sketches.select("doc", "digest", "row").join(nodes, "digest", "left")
    owned = owned.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node", "row"))
    owned = written(owned.select("doc", "digest", "row", "label"), "owned")
    # The kept row: least doc_id, and of repeated rows the first.
    classes = owned.groupBy("label").agg(F.min("doc").alias("class_id"), F.count("*").alias("class_size"))
    sized = owned.join(classes, "label").select("doc", "digest", "row", "label", "class_id", "class_size")
    least = owned.join(classes.select("label", "class_id"), "label").where(F.col("doc").eqNullSafe(F.col("class_id"))).groupBy("label").agg(F.min("row").alias("row"), F.lit(True).alias("kept"))
    out = sized.join(least.select("row", "kept"), "row", "left")
    return out.select(F.col("doc").alias(key), "digest", "class_id", "class_size", F.coalesce("kept", F.lit(False)).alias("kept"))


def keep_one(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs, in their own columns, with one document of each class."""
    columns = docs.columns
    found = written(find_classes(docs, key=key, text=text).where("kept").select(F.col(key).alias("_q_key"), F.col("digest").alias("_q_digest")), "kept")
    digest = F.unhex(F.md5(F.col(text).cast("binary")))
    same = F.col(key).eqNullSafe(F.col("_q_key")) & digest.eqNullSafe(F.col("_q_digest"))
    out = docs.join(found, same, "left_semi")
    repeated = docs.groupBy(F.col(key).alias("k"), digest.alias("d")).count().where("count > 1 and d is not null").limit(1).count()
    if repeated:
        out = out.withColumn("_q_digest", F.coalesce(digest, F.monotonically_increasing_id().cast("string").cast("binary")))
        out = out.dropDuplicates([key, "_q_digest"])
    return out.select(*columns)

"""Similarity join on word n-gram sets: MinHash banding, then exact checks.

1. One pass reads the texts and gives each its band hashes.  Equal texts form
   one class, which goes on as a single row with its number of copies.
2. Classes that share a band hash are candidates.  A band bucket gives star
   links to its smallest class (never all pairs), and connected components of
   these links gather every candidate pair in one cluster.
3. Clusters are verified on the full n-gram sets.  A large cluster is cut into
   blocks and every pair of blocks is one task, so neither a huge group of near
   copies nor a chain of them lands in one task; a task counts the links of
   each class and returns the links' spanning forest, not the pairs.
4. Link counts are summed, and the forests' components are the groups.

Band and row counts are chosen for a target recall at the threshold.

Defined results: a null or empty text (or one of white space only) has no
n-grams and links with nothing; a text shorter than the n-gram is one n-gram;
repeated rows are copies of each other; a null id is kept and counts after all
others when a group's smallest id is taken.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, shared_table
from .components import components
from .shingles import mix, shingle_set

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999
ROWS = 5
# A class weighs its n-grams plus this; blocks hold about BLOCK of weight.
EACH, BLOCK = 200, 150_000
# More increments than this in a pair of blocks are counted by matrix products.
SPARSE = 20_000_000


def band_count(threshold: float, rows: int, recall: float) -> int:
    """Bands that find a pair at the threshold with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))


def band_hashes(grams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """MinHash of the set under ``bands * rows`` hash functions, hashed by band."""
    rng = np.random.default_rng(975)
    a = rng.integers(0, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    c = rng.integers(0, 2**63, bands * rows, dtype=np.uint64)
    low = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(grams), 2048):
        low = np.minimum(low, (grams[lo:lo + 2048, None] * a + c).min(axis=0))
    out = np.arange(1, bands + 1, dtype=np.uint64)
    for r in range(rows):
        out = mix(out + low[r::rows])
    return out.view(np.int64)


def overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """|x & y| for every x of ``a`` and y of ``b``."""
    out = np.zeros((len(a), len(b)), np.int64)
    ga, gb = np.concatenate(a), np.concatenate(b)
    da = np.repeat(np.arange(len(a)), [len(x) for x in a])
    db = np.repeat(np.arange(len(b)), [len(x) for x in b])
    both = np.intersect1d(np.unique(ga), np.unique(gb), assume_unique=True)
    if not len(both):
        return out
    ia, ib = np.searchsorted(both, ga), np.searchsorted(both, gb)
    ia[ia == len(both)] = 0
    ib[ib == len(both)] = 0
    ka, kb = both[ia] == ga, both[ib] == gb
    ia, da, ib, db = ia[ka], da[ka], ib[kb], db[kb]
    oa, ob = np.argsort(ia, kind="stable"), np.argsort(ib, kind="stable")
    ia, da, ib, db = ia[oa], da[oa], ib[ob], db[ob]
    na, nb = np.bincount(ia, minlength=len(both)), np.bincount(ib, minlength=len(both))
    if int((na * nb).sum()) <= SPARSE:
        first = np.concatenate([[0], np.cumsum(nb)])[ia]
        many = nb[ia]
        left = np.repeat(da, many)
        at = np.repeat(first - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
        return np.bincount(left * len(b) + db[at], minlength=out.size).reshape(out.shape)
    ea, eb = np.concatenate([[0], np.cumsum(na)]), np.concatenate([[0], np.cumsum(nb)])
    step = 4096
    for lo in range(0, len(both), step):
        hi = min(lo + step, len(both))
        sa, sb = slice(ea[lo], ea[hi]), slice(eb[lo], eb[hi])
        x, y = np.zeros((len(a), hi - lo), np.float32), np.zeros((len(b), hi - lo), np.float32)
        x[da[sa], ia[sa] - lo] = 1
        y[db[sb], ib[sb] - lo] = 1
        out += np.rint(x @ y.T).astype(np.int64)
    return out


def _forest(linked: np.ndarray) -> np.ndarray:
    """Smallest linked position for each node of a symmetric link matrix."""
    label = np.arange(len(linked))
    while True:
        low = np.where(linked, label[None, :], len(label)).min(axis=1, initial=len(label))
        new = np.minimum(label, low)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _verify(cid: np.ndarray, copies: np.ndarray, grams: list[np.ndarray], left: np.ndarray, right: np.ndarray,
            threshold: float, within: bool) -> list[tuple[int, int, int]]:
    """(class, linked documents, root of its links) for the classes with links
    between the ``left`` and ``right`` positions."""
    sa, sb = (np.array([len(grams[i]) for i in side]) for side in (left, right))
    inter = overlaps([grams[i] for i in left], [grams[i] for i in right])
    hit = inter >= threshold * (sa[:, None] + sb[None, :] - inter) - 1e-9
    if within:
        np.fill_diagonal(hit, False)
        rows = [(int(cid[left[i]]), int(copies[right][hit[i]].sum())) for i in np.flatnonzero(hit.any(axis=1))]
        label = _forest(hit)
        return [(c, n, int(cid[left[label[i]]])) for (c, n), i in zip(rows, np.flatnonzero(hit.any(axis=1)))]
    n = len(left) + len(right)
    whole = np.zeros((n, n), bool)
    whole[:len(left), len(left):] = hit
    whole[len(left):, :len(left)] = hit.T
    label, pos = _forest(whole), np.concatenate([left, right])
    linked = np.flatnonzero(whole.any(axis=1))
    weight = copies[pos]
    return [(int(cid[pos[i]]), int(weight[whole[i]].sum()), int(cid[pos[label[i]]])) for i in linked]


def signatures(df: DataFrame, id_col: str, text_col: str, words: int, bands: int, rows: int) -> DataFrame:
    """(id, text_key, size, bands): one row for each row."""
    prepare(df.sparkSession)
    narrow = df.select(F.col(id_col).alias("id"), F.md5(F.col(text_col)).alias("text_key"),
                       F.col(text_col).alias("_text"))
    schema = "id long, text_key string, size long, bands array<bigint>"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, out = [], []
            for t in b.column(2).to_pylist():
                g = shingle_set(t, words)
                size.append(len(g))
                out.append(band_hashes(g, bands, rows) if len(g) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(size, pa.int64()),
                                              pa.array(out, pa.list_(pa.int64()))], ["id", "text_key", "size", "bands"])

    return narrow.mapInArrow(sign, schema)


def similarity_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS) -> DataFrame:
    """One row for each row of ``df``: the id, ``text_key`` (of its exact copies),
    ``class_id`` (smallest id of the group of texts reachable by links, itself
    included) and ``n_links`` (other rows whose similarity is at least the
    threshold, copies included)."""
    narrow = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = shared_table(signatures(narrow, "id", "text", words, band_count(threshold, rows, recall), rows), "signed")
    classes = (signed.filter(F.col("size") > 0).groupBy("text_key")
               .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.any_value("size").alias("size"),
                    F.any_value("bands").alias("bands"))
               .withColumn("cid", F.monotonically_increasing_id()))
    classes = shared_table(classes, "classes")

    # candidates: star links inside each band bucket, then clusters
    banded = classes.select("cid", F.posexplode("bands").alias("band", "h")).select("cid", F.xxhash64("band", "h").alias("h"))
    shared = shared_table(banded.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("cid").alias("hub"))
                          .filter(F.col("n") > 1).select("h", "hub"), "buckets")
    stars = banded.hint("merge").join(shared, "h").select(F.col("hub").alias("a"), F.col("cid").alias("b"))
    clusters = components(stars).select(F.col("node").alias("cid"), F.col("component").alias("cluster"))
    members = shared_table(classes.select("cid", "text_key", "rep", "copies", "size").join(clusters, "cid"), "members")

    # blocks: small clusters share a task, large ones are cut
    weight = F.col("size") + EACH
    sized = members.groupBy("cluster").agg(F.sum(weight).alias("weight")).withColumn(
        "blocks", F.ceil(F.col("weight") / BLOCK))
    sized = shared_table(sized, "clusters")
    small = sized.filter(F.col("blocks") == 1).agg(F.sum("weight")).first()[0] or 0
    shares = max(1, math.ceil(small / BLOCK))
    placed = (members.join(sized, "cluster")
              .withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")))
              .withColumn("pair", F.explode(F.transform(
                  F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
                  lambda x: F.struct(F.least(x, F.col("block")).alias("lo"), F.greatest(x, F.col("block")).alias("hi")))))
              .withColumn("task", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("cluster"), F.lit(shares)))
                          .otherwise(F.xxhash64("cluster", "pair.lo", "pair.hi"))))
    texts = (narrow.withColumn("text_key", F.md5("text")).filter(F.col("text_key").isNotNull()).withColumnRenamed("id", "rep"))
    picked = (members.select("cid", "text_key", "rep").hint("merge")
              .join(texts, members["text_key"].eqNullSafe(texts["text_key"]) & members["rep"].eqNullSafe(texts["rep"]))
              .select("cid", "text").dropDuplicates(["cid"]))
    work = placed.select("cid", "copies", "cluster", "block", F.col("pair.lo").alias("lo"), F.col("pair.hi").alias("hi"),
                         "task").join(picked, "cid")

    def verify(t: pa.Table) -> pa.Table:
        d = {c: t.column(c).to_numpy() for c in ("cid", "copies", "cluster", "block", "lo", "hi")}
        texts = t.column("text").to_pylist()
        found: list[tuple[int, int, int]] = []
        key = np.stack([d["cluster"], d["lo"], d["hi"]], axis=1)
        _, group = np.unique(key, axis=0, return_inverse=True)
        group = group.ravel()
        for g in np.split(np.argsort(group, kind="stable"), np.flatnonzero(np.diff(np.sort(group))) + 1):
            g = g[np.argsort(d["cid"][g])]
            cid, copies = d["cid"][g], d["copies"][g]
            grams = [shingle_set(texts[i], words) for i in g]
            lo, hi = d["lo"][g[0]], d["hi"][g[0]]
            left, right = np.flatnonzero(d["block"][g] == lo), np.flatnonzero(d["block"][g] == hi)
            if len(left) and len(right):
                found += _verify(cid, copies, grams, left, right, threshold, lo == hi)
        cols = list(zip(*found)) or [[], [], []]
        return pa.table([pa.array(c, pa.int64()) for c in cols], ["cid", "n", "root"])

    links = shared_table(work.groupBy("task").applyInArrow(verify, "cid long, n long, root long"), "verified")
    groups = components(links.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    groups = groups.select(F.col("node").alias("cid"), F.col("component").alias("group"))
    counted = links.groupBy("cid").agg(F.sum("n").alias("n"))
    graded = (classes.select("cid", "text_key", "rep", "copies").join(counted, "cid", "left").join(groups, "cid", "left")
              .withColumn("group", F.coalesce("group", "cid")))
    graded = shared_table(graded, "graded")
    smallest = shared_table(graded.groupBy(F.col("group").alias("_g")).agg(F.min("rep").alias("class_id")), "smallest")
    result = shared_table(graded.join(smallest, F.col("group") == F.col("_g"))
                          .select(F.col("text_key").alias("_key"), "class_id",
                                  (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "result")
    return (signed.select("id", "text_key").hint("merge").join(result, F.col("text_key") == F.col("_key"), "left")
            .select(F.col("id").alias(id_col), "text_key",
                    F.when(F.col("_key").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")))

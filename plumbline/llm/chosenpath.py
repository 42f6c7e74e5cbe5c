"""N-gram Jaccard self-join by chosen paths: sets are split on sampled shared tokens, small or tight buckets are compared whole."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import checked_broadcast, columns_of, components, free_name, mixed, offsets, shingles, slices, stored

#: Words of a shingle, similarity of a link, tokens of a set's sketch, tokens sampled at a node.
SHINGLE, SIMILARITY, TOKENS, SAMPLED = 5, 0.8, 64, 2
#: The share of linked pairs that must meet in some bucket.
RECALL = 0.9995
#: Sets that are compared with each other at once; a child with this share of its parent is not split again.
BLOCK, TIGHT = 256, 0.7


def runs_for(recall: float, similarity: float, sampled: int = SAMPLED) -> int:
    """Repetitions that reach the recall at any depth: a linked pair parts at a node if no sampled token is shared, or if it parts
    below each that is; the probability is the smallest root of f = (1 - s (1 - f)) ^ sampled."""
    f = 0.0
    for _ in range(200):
        f = (1 - similarity * (1 - f)) ** sampled
    return max(1, math.ceil(math.log(1 - recall) / math.log(f)))


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    x = mixed(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return x[:n], x[n:] | np.uint64(1)


def sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingle set of each text as its size, two sums that identify it, and the least of TOKENS hash functions."""
    a, b = _seeds(TOKENS)
    for batch in batches:
        for first, texts in slices(batch):
            h, counts = shingles(texts, SHINGLE)
            at = offsets(counts)
            sets = [np.unique(h[at[i]:at[i + 1]]) for i in range(len(texts))]
            n = np.array([len(s) for s in sets], np.int64)
            flat = np.concatenate(sets) if sets else h
            full = np.flatnonzero(n)
            sums = np.zeros((len(texts), 2), np.uint64)
            sk = np.zeros((len(texts), TOKENS), np.uint32)
            if len(full):
                begins = offsets(n)[:-1][full]
                with np.errstate(over="ignore"):
                    sums[full, 0] = np.add.reduceat(mixed(flat), begins)
                    sums[full, 1] = np.add.reduceat(mixed(flat ^ np.uint64(0x5851F42D4C957F2D)), begins)
                    for j in range(TOKENS):
                        x = (((flat ^ a[j]) * b[j]) >> np.uint64(32)).astype(np.uint32)
                        sk[full, j] = np.minimum.reduceat(x, begins)
            ids = batch.column(batch.schema.get_field_index("doc_id")).slice(first, len(texts))
            text_hash = batch.column(batch.schema.get_field_index("print")).slice(first, len(texts))
            yield pa.RecordBatch.from_arrays([ids, text_hash, pa.array(n), pa.array(sums[:, 0].view(np.int64)), pa.array(sums[:, 1].view(np.int64)), pa.array([r.tobytes() for r in sk], pa.binary())],
                                             ["doc_id", "print", "n", "f1", "f2", "sketch"])


SETS = "doc_id long, print long, n long, f1 long, f2 long, sketch binary"


def _children(rep: np.ndarray, node: np.ndarray, sketch: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
    """Each node samples SAMPLED slots of the sketch by a hash of its path; its sets go on by the token they have there."""
    out_node, out_rep, out_size = [], [], []
    rows = np.arange(len(rep))
    with np.errstate(over="ignore"):
        start = mixed(node) % np.uint64(TOKENS)
        step = np.uint64(1) + (mixed(node ^ np.uint64(0xA5A5)) >> np.uint64(8)) % np.uint64(TOKENS - 1)
        for j in range(SAMPLED):
            slot = (start + step * np.uint64(j)) % np.uint64(TOKENS)
            value = sketch[rows, slot.astype(np.int64)].astype(np.uint64)
            out_node.append(mixed(mixed(node + slot) + value))
            out_rep.append(rep.astype(np.int64))
            out_size.append(size.astype(np.int64))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_node).view(np.int64)), pa.array(np.concatenate(out_rep)), pa.array(np.concatenate(out_size))], ["node", "rep", "parent_size"])


def _split(df: DataFrame) -> DataFrame:
    def step(batches):
        for batch in batches:
            if batch.num_rows:
                get = lambda c: batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
                sk = np.frombuffer(b"".join(get("sketch")), "<u4").reshape(-1, TOKENS)
                yield _children(get("rep"), get("node").view(np.uint64), sk, get("size"))

    return df.select("rep", "node", "sketch", "size").mapInArrow(step, "node long, rep long, parent_size long")


def buckets(reps: DataFrame, runs: int, block: int = BLOCK, tight: float = TIGHT) -> DataFrame:
    """(node, rep, size): the leaves with two sets or more. A child of at most block sets is a leaf; a larger one is split again
    unless nearly all of its parent came along, as in a group of near copies."""
    total = reps.count()
    roots = reps.select("rep", "sketch", F.lit(total).alias("size"), F.explode(F.array(*[F.lit(i) for i in range(runs)])).alias("run"))
    level = _split(roots.select("rep", "sketch", "size", F.xxhash64(F.lit("root"), "run").alias("node")))
    leaves = None
    depth = 0
    while True:
        level = stored(level, f"paths-{depth}")
        sizes = stored(level.groupBy("node").agg(F.count("*").alias("size")).where("size > 1"), f"nodes-{depth}")
        sized = level.join(sizes, "node")
        done = (F.col("size") <= block) | (F.col("size") >= tight * F.col("parent_size"))
        own = sized.where(done).select("node", "rep", "size")
        leaves = own if leaves is None else leaves.union(own)
        if not sizes.where(F.col("size") > block).limit(1).count():
            return leaves
        rest = stored(sized.where(~done).select("node", "rep", "size"), f"open-{depth}")
        if not rest.limit(1).count():
            return leaves
        level = _split(rest.join(reps.select("rep", "sketch"), "rep"))
        depth += 1


def block_pairs(df: DataFrame, block: int) -> DataFrame:
    """Rows of a group of size sets, dealt to blocks by a hash and sent to every pair (bi, bj) of blocks that includes their own."""
    n = F.ceil(F.col("size") / block).cast("int")
    own = F.pmod(F.xxhash64("rep"), n).cast("int")
    other = F.explode(F.sequence(F.lit(0), n - 1))
    return (df.withColumn("_own", own).withColumn("_other", other)
            .withColumn("bi", F.least("_own", "_other")).withColumn("bj", F.greatest("_own", "_other")).drop("_other"))


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric boolean matrix."""
    seen = np.zeros(len(linked), bool)
    out = []
    for root in range(len(linked)):
        if seen[root]:
            continue
        seen[root] = True
        stack = [root]
        while stack:
            i = stack.pop()
            new = np.flatnonzero(linked[i] & ~seen)
            seen[new] = True
            out += [(i, int(j)) for j in new]
            stack += new.tolist()
    return out


def _joins(linked: np.ndarray, own: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what the links inside the blocks leave apart: a forest over the components of the blocks."""
    inside = own[:, None] == own[None, :]
    part = np.arange(len(linked))
    for i, j in _forest(linked & inside):
        part[j] = part[i]  # a forest is listed from its roots down
    i, j = np.nonzero(np.triu(linked & ~inside))
    _, first = np.unique(part[i] * len(linked) + part[j], return_index=True)
    root = list(range(len(linked)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for k in first.tolist():
        a, b = find(int(part[i[k]])), find(int(part[j[k]]))
        if a != b:
            root[a] = b
            out.append((int(i[k]), int(j[k])))
    return out


def candidates(leaves: DataFrame, reps: DataFrame, similarity: float, block: int = BLOCK) -> DataFrame:
    """(a, b): a spanning forest of the pairs of each leaf that the sketches do not rule out. A linked pair falls below this bound
    on the estimate with a probability under 1 in 10,000."""
    least = math.floor(TOKENS * similarity - 4 * math.sqrt(TOKENS * similarity * (1 - similarity)))

    def compare(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        sk = np.frombuffer(b"".join(pdf["sketch"]), "<u4").reshape(-1, TOKENS)
        n, rep = pdf["n"].to_numpy(), pdf["rep"].to_numpy()
        same = np.zeros((len(n), len(n)), np.uint8)
        for j in range(TOKENS):
            same += sk[:, j][:, None] == sk[:, j][None, :]
        linked = (same >= least) & (np.minimum(n[:, None], n[None, :]) >= similarity * np.maximum(n[:, None], n[None, :]) - 1e-9)
        # links inside a block are told where the block meets itself
        edges = _forest(linked) if key[1] == key[2] else _joins(linked, pdf["_own"].to_numpy())
        return pd.DataFrame({"a": [rep[i] for i, _ in edges], "b": [rep[j] for _, j in edges]}, dtype="int64")

    rows = block_pairs(leaves.join(reps.select("rep", "n", "sketch"), "rep"), block)
    return rows.select("node", "bi", "bj", "_own", "rep", "n", "sketch").groupBy("node", "bi", "bj").applyInPandas(compare, "a long, b long")


def _verified(similarity: float, bi: int, bj: int, pdf: pd.DataFrame) -> pd.DataFrame:
    """Exact Jaccard of all pairs of two blocks (of one, if they are the same): links of each set and a spanning forest."""
    pdf = pdf.drop_duplicates("rep")
    n, rep, own, copies = (pdf[c].to_numpy() for c in ("n", "rep", "_own", "copies"))
    sets = [np.frombuffer(t, "<u8") for t in pdf["tokens"]]
    _, code, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = df[code] > 1  # a token of one set alone joins nothing
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[shared]
    _, col = np.unique(code[shared], return_inverse=True)
    inter = np.zeros((len(sets), len(sets)), np.float32)
    width = 8192
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    for lo in range(0, int(col.max()) + 1 if len(col) else 0, width):
        a, b = np.searchsorted(col, [lo, lo + width])
        m = np.zeros((len(sets), width), np.float32)
        m[row[a:b], col[a:b] - lo] = 1
        inter += m @ m.T
    union = n[:, None] + n[None, :] - inter
    linked = inter >= similarity * union - 1e-6
    np.fill_diagonal(linked, False)
    counted = linked if bi == bj else linked & (own[:, None] != own[None, :])
    links = counted @ copies
    edges = _forest(linked) if bi == bj else _joins(linked, own)
    return pd.DataFrame({"rep": np.r_[rep, rep[[i for i, _ in edges]]].astype("int64"), "links": np.r_[links, np.zeros(len(edges))].astype("int64"),
                         "peer": pd.array([None] * len(rep) + [int(rep[j]) for _, j in edges], dtype="Int64")})


def similar(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """(doc_id, print, class_id, n_links) for every row: links are other rows whose sets of lower-case five-word shingles have a
    Jaccard similarity of at least similarity, copies included; a class is what links connect, named by its smallest doc_id.

    Rows with equal sets are one set with a count. Sets meet in buckets of chosen paths over MinHash tokens, in as many runs as the
    recall asks for; sets that the sketches may link form candidate groups, and within a group all pairs are compared exactly, so
    a pair that no bucket holds is still found through others. Large groups are compared in pairs of blocks; neither pairs nor
    groups are collected. A text of 1 to 4 words is one shingle; null and empty texts and rows with a null doc_id link to nothing
    and have their own doc_id as class. print is the hash of the row's text.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("print"))
    sets = stored(plain.mapInArrow(sketch_rows, SETS), "sets")
    usable = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    reps = sets.where(usable).groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("copies"), F.first("sketch").alias("sketch"))
    reps = stored(reps.withColumn("rep", F.monotonically_increasing_id()), "reps")
    leaves = buckets(reps, runs_for(recall, similarity), block)
    edges = stored(candidates(leaves, reps, similarity, block), "candidates")
    groups = components(edges, "groups")
    sizes = groups.groupBy("component").agg(F.count("*").alias("size"))
    member = groups.join(sizes, "component").join(reps.drop("sketch"), F.col("node") == F.col("rep"))
    members = stored(member.select("rep", "component", "size", "first_doc", "copies", "n", "f1", "f2"), "members")

    def tokens(batches):
        for batch in batches:
            for first, texts in slices(batch):
                h, counts = shingles(texts, SHINGLE)
                at = offsets(counts)
                part = batch.slice(first, len(texts))
                cols = {c: part.column(part.schema.get_field_index(c)) for c in part.schema.names if c != "text"}
                out, keep = [], []
                f1, f2 = (cols[c].to_numpy().view(np.uint64) for c in ("f1", "f2"))
                for i in range(len(texts)):
                    s = np.unique(h[at[i]:at[i + 1]])
                    with np.errstate(over="ignore"):
                        keep.append(mixed(s).sum() == f1[i] and mixed(s ^ np.uint64(0x5851F42D4C957F2D)).sum() == f2[i])
                    out.append(s.astype("<u8").tobytes() if keep[-1] else b"")
                mask = pa.array([bool(k) for k in keep])
                yield pa.RecordBatch.from_arrays([*cols.values(), pa.array(out, pa.binary())], [*cols, "tokens"]).filter(mask)

    held = plain.select("doc_id", "text").join(checked_broadcast(members), F.col("doc_id") == F.col("first_doc")).select("rep", "component", "size", "copies", "n", "f1", "f2", "text")
    shipped = held.mapInArrow(tokens, "rep long, component long, size long, copies long, n long, f1 long, f2 long, tokens binary").drop("f1", "f2")
    paired = block_pairs(shipped, block).drop("size")
    got = paired.groupBy("component", "bi", "bj").applyInPandas(
        lambda key, pdf: _verified(similarity, key[1], key[2], pdf), "rep long, links long, peer long")
    found = stored(got, "links")
    classes = components(found.where("peer IS NOT NULL").select(F.col("rep").alias("a"), F.col("peer").alias("b")), "classes")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    named = reps.drop("sketch").join(links, "rep", "left").join(classes.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.withColumn("component", F.coalesce("component", "rep"))
    first = named.groupBy("component").agg(F.min("first_doc").alias("class_id"))
    named = stored(named.join(first, "component").select("n", "f1", "f2", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "named")
    none = sets.where(~usable | F.col("doc_id").isNull()).select("doc_id", "print", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    some = sets.where(usable).drop("sketch").join(named, ["n", "f1", "f2"]).select("doc_id", "print", "class_id", "n_links")
    return some.union(none)


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """One document of each class, that with the smallest doc_id; rows that repeat it stay once. Rows without words or without a
    doc_id are kept. Columns are as given."""
    rows = stored(similar(docs, **options), "similar")
    drop = rows.where("doc_id <> class_id").select(F.col("doc_id").alias("_id"), F.col("print").alias("_print")).distinct()
    drop = stored(drop, "drop")
    twice = stored(rows.where("doc_id = class_id AND n_links > 0").groupBy("doc_id", "print").count().where("count > 1")
                   .select(F.col("doc_id").alias("_id"), F.col("print").alias("_print")), "twice")
    name = free_name(docs, "_text_hash")
    keyed = docs.withColumn(name, F.xxhash64("text"))
    same = lambda t: (keyed["doc_id"] == t["_id"]) & (keyed[name] == t["_print"])
    kept = keyed.join(checked_broadcast(drop), same(drop), "left_anti")
    if not twice.limit(1).count():
        return kept.select(*columns_of(docs))
    single = kept.join(checked_broadcast(twice), same(twice), "left_anti").select(*columns_of(docs))
    again = kept.join(checked_broadcast(twice), same(twice), "left_semi").dropDuplicates(["doc_id", name]).select(*columns_of(docs))
    return single.union(again)

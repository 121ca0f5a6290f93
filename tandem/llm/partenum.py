"""N-gram Jaccard join by PartEnum signatures (operator 3).

A document's set holds the hashes of its distinct word k-grams.  Jaccard
similarity J of two sets of size at most r bounds their symmetric difference
by floor(2r (1-J)/(1+J)) = d.  Sizes are cut into bands [l, l/J]; similar sets
lie in one band or in neighbouring ones, so a set gets signatures for its own
band and the next.  For a band, the feature domain is dealt into n1 first-level
partitions of n2 parts each, with n1 (k2 + 1) > d: some first-level partition
then differs in at most k2 elements, so some n2 - k2 of its parts are equal in
both sets.  Every choice of n2 - k2 parts is a signature.  Sharing one is
necessary for similarity; candidates are then verified exactly.

Equal sets are collapsed before any pair is formed.  Signatures go through one
exchange, keyed by signature, without text.  A signature group is compared
with one pivot (its member with the most shared signatures), members of a
pivot being dealt over several tasks, and components are formed (pairs whose sizes, or whose counts in CELLS parts of the
domain, rule the similarity out are dropped before any text moves).  Signature
groups that still lie in several components are put together to candidate
groups; each is cut into tiles, and a task compares all sets of two tiles by
matrix products over their shared shingles.  It returns the local components,
so the rows stay linear in the documents and no link is lost.

Cases: null or wordless texts have an empty set, no links and are their own
component; fewer words than k make one shingle of the whole sequence; repeated
rows and equal texts share a component; a row with null id joins a component
only through an equal set that has an id; other columns are ignored.
Set identity and shingles are 64-bit hashes.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tandem.llm.common import (BYTE_CODE, LOWER_CODE, SPACE, _components, _mix, connected_components, documents,
                               join_small, ngrams, python_ready, steps, words, written)

#: Members compared with one copy of a pivot's text, sets in a tile of texts,
#: and sets in a tile of cell counts.
PER_PIVOT, TILE, GROUP_TILE = 256, 256, 4096
#: Cells of the counts that bound a pair's difference from below.
CELLS = 256
#: Shingles of one matrix product.
COLUMNS = 4096
N2, K2 = 2, 1
_U = np.uint64


def shingle_sets(data, offs, k: int, lower: bool = True):
    """(values, offsets): the sorted distinct shingle hashes of each document."""
    _, _, doc, h = words(data, offs, SPACE, LOWER_CODE if lower else BYTE_CODE)
    n_docs = len(offs) - 1
    g, ok = ngrams(h, doc, k)
    g, d = g[ok], doc[:len(g)][ok]
    count = np.bincount(doc, minlength=n_docs)
    few = np.flatnonzero((count > 0) & (count < k))
    if len(few):
        first = np.concatenate(([0], np.cumsum(count)))
        with np.errstate(over="ignore"):
            one = []
            for i in few:
                x = _U(count[i])
                for v in h[first[i]:first[i + 1]]:
                    x = x * _U(0x9E3779B97F4A7C15) + v
                one.append(x)
            one = _mix(np.array(one, _U) ^ _U(0x5851F42D4C957F2D))
        d = np.concatenate((d, few))
        order = np.argsort(d, kind="stable")
        d, g = d[order], np.concatenate((g, one))[order]
    bound = np.searchsorted(d, np.arange(n_docs + 1))
    g = g.copy()
    for i in np.flatnonzero(np.diff(bound) > 1):
        g[bound[i]:bound[i + 1]].sort()
    keep = np.ones(len(g), bool)
    keep[1:] = (g[1:] != g[:-1]) | (d[1:] != d[:-1])
    g, d = g[keep], d[keep]
    return g, np.searchsorted(d, np.arange(n_docs + 1))


def set_ids(g, bound):
    """A 64-bit identity of each set (0 for the empty set)."""
    with np.errstate(over="ignore"):
        c = np.concatenate((np.zeros(1, _U), np.cumsum(_mix(g ^ _U(0xA0761D6478BD642F)), dtype=_U)))
        n = np.diff(bound)
        return np.where(n > 0, _mix((c[bound[1:]] - c[bound[:-1]]) + n.astype(_U) * _U(0x9E3779B97F4A7C15)), 0)


@lru_cache
def bands(num: int, den: int, upto: int = 1 << 40) -> tuple[np.ndarray, np.ndarray]:
    """Upper sizes of the bands and the largest symmetric difference in each,
    for similarity num/den."""
    top, low = [], 1
    while low <= upto:
        top.append(low * den // num)
        low = top[-1] + 1
    top = np.array(top, np.int64)
    return top, 2 * top * (den - num) // (den + num)


def signatures(g, bound, num: int, den: int, n2: int = N2, k2: int = K2):
    """(document index, signature) rows of all sets of a step.  Sets so small
    that only equality links them get none."""
    top, diff = bands(num, den)
    n = np.diff(bound)
    own = np.searchsorted(top, n)
    docs, sigs = [], []
    with np.errstate(over="ignore"):
        mixed = _mix(g + _U(0x2545F4914F6CDD1D))
        for step in (0, 1):
            d = diff[own + step]
            n1 = -(-(d + 1) // (k2 + 1))
            who = np.flatnonzero((n > 0) & (d > 0))
            if not len(who):
                continue
            size = n1[who] * n2
            base = np.concatenate(([0], np.cumsum(size)))
            rows = np.repeat(np.arange(len(who)), n[who])
            at = np.concatenate([np.arange(bound[i], bound[i + 1]) for i in who])
            cell = base[rows] + (g[at] % size[rows].astype(_U)).astype(np.int64)
            acc = np.zeros(base[-1], _U)
            np.add.at(acc, cell, mixed[at])
            acc = acc.reshape(-1, n2)
            owner = np.repeat(who, n1[who])
            part = np.arange(len(owner)) - np.repeat(base[:-1] // n2, n1[who])
            salt = _mix(part.astype(_U) * _U(0x9E3779B97F4A7C15) + (own[owner] + step).astype(_U))
            for j, c in enumerate(combinations(range(n2), n2 - k2)):
                s = salt + _U(j + 1)
                for col in c:
                    s = _mix(s ^ acc[:, col])
                docs.append(owner)
                sigs.append(s)
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    return np.concatenate(docs), np.concatenate(sigs)


def cell_counts(g, bound) -> np.ndarray:
    """Each set's number of elements in CELLS parts of the domain, 255 at most."""
    n = len(bound) - 1
    owner = np.repeat(np.arange(n), np.diff(bound))
    cell = (_mix(g + _U(0x60BEE2BEE120FC15)) % _U(CELLS)).astype(np.int64)
    return np.minimum(np.bincount(owner * CELLS + cell, minlength=n * CELLS), 255).astype(np.uint8).reshape(n, CELLS)


def _scan_sets(k):
    def run(batches):
        for part, data, offs in steps(batches):
            g, bound = shingle_sets(data, offs, k)
            sid = set_ids(g, bound)
            cells = pa.array([row.tobytes() for row in cell_counts(g, bound)], pa.binary())
            yield pa.record_batch([part.column("doc_id"), pa.array(np.diff(bound)),
                                   pa.array(sid.view(np.int64), mask=sid == 0), cells],
                                  ["doc_id", "n_shingles", "sid", "cells"])
    return run


def _possible(num, den):
    """Pairs whose sizes and cell counts allow the similarity: the symmetric
    difference is at least the sum of the cells' differences."""
    def run(batches):
        for b in batches:
            for s in range(0, len(b), 4096):
                part = b.slice(s, 4096)
                if not len(part):
                    continue
                na, nb = (part.column(c).to_numpy() for c in ("na", "nb"))
                x, y = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint8).reshape(-1, CELLS).astype(np.int16)
                        for c in ("xa", "xb"))
                apart = np.abs(x - y).sum(axis=1, dtype=np.int64)
                ok = (den + num) * apart <= (den - num) * (na + nb)
                ok &= den * np.minimum(na, nb) >= num * np.maximum(na, nb)
                yield part.select(["a", "b"]).filter(pa.array(ok))
    return run


def _scan_signatures(k, num, den, n2, k2):
    def run(batches):
        seen: set = set()  # a task signs equal sets once
        for _, data, offs in steps(batches):
            g, bound = shingle_sets(data, offs, k)
            sid = set_ids(g, bound)
            doc, sig = signatures(g, bound, num, den, n2, k2)
            first = np.zeros(len(sid), bool)
            for i, s in enumerate(sid.tolist()):
                if s not in seen:
                    seen.add(s)
                    first[i] = True
            keep = first[doc]
            yield pa.record_batch([pa.array(sig[keep].view(np.int64)), pa.array(sid[doc[keep]].view(np.int64))],
                                  ["sig", "sid"])
    return run


def _verify(k, num, den):
    """Rows ordered by (a, salt), pivot first: the links among them."""
    def run(batches):
        pivot, group = None, None
        for part, data, offs in steps(batches):
            g, bound = shingle_sets(data, offs, k)
            sid = set_ids(g, bound).view(np.int64)
            a, salt, want = (part.column(c).to_pylist() for c in ("a", "salt", "sid"))
            out = [], []
            for i in range(len(a)):
                if sid[i] != want[i]:
                    continue  # another row under the same id
                mine = g[bound[i]:bound[i + 1]]
                if want[i] == a[i]:
                    pivot, group = mine.copy(), (a[i], salt[i])
                elif group == (a[i], salt[i]):
                    both = len(np.intersect1d(pivot, mine, assume_unique=True))
                    if den * both >= num * (len(pivot) + len(mine) - both):
                        out[0].append(a[i])
                        out[1].append(want[i])
            yield pa.record_batch([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64())], ["a", "b"])
    return run


def linked(values: list[np.ndarray], cut: int, num: int, den: int):
    """Index pairs of similar sets; with ``cut`` only those across it."""
    n, size = len(values), np.array([len(v) for v in values])
    who = np.repeat(np.arange(n), size)
    g, inv, count = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
    shared = count[inv] > 1
    # shingles of one set alone add nothing to an intersection
    col = (np.cumsum(count > 1) - 1)[inv[shared]]
    who = who[shared]
    order = np.argsort(col, kind="stable")
    col, who = col[order], who[order]
    split = cut or n
    both = np.zeros((split, n - cut))
    for s in range(0, int(col[-1]) + 1 if len(col) else 0, COLUMNS):
        a, z = np.searchsorted(col, (s, s + COLUMNS))
        m = np.zeros((n, COLUMNS), np.float32)
        m[who[a:z], col[a:z] - s] = 1
        both += m[:split] @ m[cut:].T
    both = np.rint(both).astype(np.int64)
    hit = den * both >= num * (size[:split, None] + size[None, cut:] - both)
    i, j = np.nonzero(hit if cut else np.triu(hit, 1))
    return i, j + cut


def _compare_tiles(k, num, den):
    """Rows in order of (grp, ta, tb, tile): every set's local component."""
    def run(batches):
        key, held, ids, tiles = None, [], [], []

        def close():
            cut = 0 if key[1] == key[2] else tiles.count(key[1])
            i, j = linked(held, cut, num, den) if cut < len(held) else ((), ())
            low = _components(len(ids), np.asarray(i, np.int64), np.asarray(j, np.int64))
            sid = np.array(ids, np.int64)
            hit = low != np.arange(len(ids))
            yield pa.record_batch([pa.array(sid[hit]), pa.array(sid[low[hit]])], ["a", "b"])

        for part, data, offs in steps(batches):
            g, bound = shingle_sets(data, offs, k)
            sid = set_ids(g, bound).view(np.int64)
            grp, ta, tb, tile, want = (part.column(c).to_pylist() for c in ("grp", "ta", "tb", "tile", "sid"))
            for i in range(len(grp)):
                if (grp[i], ta[i], tb[i]) != key:
                    if held:
                        yield from close()
                    key, held, ids, tiles = (grp[i], ta[i], tb[i]), [], [], []
                if sid[i] == want[i] and (not ids or ids[-1] != want[i]):
                    held.append(g[bound[i]:bound[i + 1]].copy())
                    ids.append(want[i])
                    tiles.append(tile[i])
        if held:
            yield from close()
    return run


def _possible_groups(num, den, block: int = 256):
    """Rows in order of (sig, ta, tb, tile): for every pair of a signature
    group's tiles, the local components of the pairs that sizes and cell counts
    allow.  Pairs are folded into the components block by block."""
    def run(batches):
        key, ids, size, cells, tiles = None, [], [], [], []

        def close():
            x = np.frombuffer(b"".join(cells), np.uint8).reshape(-1, CELLS).astype(np.int16)
            n, low = np.array(size, np.int64), np.arange(len(ids))
            own = key[1] == key[2]
            cut = len(n) if own else tiles.count(key[1])
            for s in range(0, cut, block):
                first = slice(s, min(s + block, cut))
                for t in range(s if own else cut, len(n), block):
                    a, b = x[first], x[t:t + block]
                    apart = np.stack([np.abs(b - row).sum(axis=1, dtype=np.int64) for row in a])
                    ok = (den + num) * apart <= (den - num) * (n[first, None] + n[None, t:t + block])
                    i, j = np.nonzero(np.triu(ok, 1) if own and s == t else ok)
                    i, j = low[i + s], low[j + t]
                    new = i != j
                    if new.any():
                        low = _components(len(n), i[new], j[new])[low]
            sid = np.array(ids, np.int64)
            hit = low != np.arange(len(n))
            return sid[hit], sid[low[hit]]

        out = [], []
        for b in batches:
            for *k, tile, sid, n, c in zip(*(b.column(x).to_pylist() for x in (
                    "sig", "ta", "tb", "tile", "sid", "n_shingles", "cells")), strict=True):
                if k != key:
                    if len(ids) > 1:
                        for o, v in zip(out, close(), strict=True):
                            o.append(v)
                    key, ids, size, cells, tiles = k, [], [], [], []
                ids.append(sid)
                size.append(n)
                cells.append(c)
                tiles.append(tile)
            if out[0]:
                yield pa.record_batch([pa.array(np.concatenate(o)) for o in out], ["a", "b"])
                out = [], []
        if len(ids) > 1:
            yield pa.record_batch([pa.array(v) for v in close()], ["a", "b"])
    return run


def possible_links(held: DataFrame, reps: DataFrame, num, den, tile: int | None = None) -> DataFrame:
    """Edges among the sets of each signature of ``held`` (sig, sid) that join
    all pairs which sizes and cell counts allow.  A group above ``tile`` sets is
    cut by a hash into tiles, and each pair of tiles is a group of its own, so
    that a task holds two tiles at most."""
    big = held.groupBy("sig").agg(F.ceil(F.count(F.lit(1)) / (tile or GROUP_TILE)).cast("int").alias("tiles")).where("tiles > 1")
    rows = join_small(held, big, ["sig"], "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    rows = rows.withColumn("tile", F.pmod(F.xxhash64("sid", F.lit(7)), F.col("tiles")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    rows = rows.select("sig", "sid", "tile", F.least("tile", "other").alias("ta"), F.greatest("tile", "other").alias("tb"))
    rows = rows.join(reps.select("sid", "n_shingles", "cells"), "sid").repartition("sig", "ta", "tb")
    rows = rows.sortWithinPartitions("sig", "ta", "tb", "tile").select("sig", "ta", "tb", "tile", "sid", "n_shingles", "cells")
    return rows.mapInArrow(_possible_groups(num, den), "a long, b long")


def _links_in_groups(docs, held, reps, k, num, den) -> DataFrame:
    """Links among the sets of signature groups ``held`` (sig, sid), as local
    components of the candidate groups that their possible pairs form."""
    edges = possible_links(held, reps, num, den)
    group = written(connected_components(edges).toDF("sid", "grp"), "groups")
    size = group.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    entry = join_small(group, size, ["grp"]).withColumn(
        "tile", F.pmod(F.xxhash64("sid"), F.col("tiles")).cast("int"))
    entry = entry.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    entry = entry.select("sid", "grp", "tile", F.least("tile", "other").alias("ta"), F.greatest("tile", "other").alias("tb"))
    ids = reps.where("doc_id is not null").select("sid", "doc_id")
    texts = docs.join(ids.join(group.select("sid"), "sid"), "doc_id").select("sid", "text")
    rows = texts.join(entry, "sid").repartition("grp", "ta", "tb").sortWithinPartitions("grp", "ta", "tb", "tile", "sid")
    return written(rows.mapInArrow(_compare_tiles(k, num, den), "a long, b long"), "tile-links")


def _verified(docs, pairs, reps, k, num, den) -> DataFrame:
    """The pairs (a, b) of set ids whose similarity reaches num/den."""
    side = reps.select("sid", "n_shingles", "cells")
    pairs = pairs.join(side.toDF("a", "na", "xa"), "a").join(side.toDF("b", "nb", "xb"), "b") \
                 .mapInArrow(_possible(num, den), "a long, b long")
    pairs = written(pairs, "possible")
    many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PER_PIVOT).cast("int").alias("parts"))
    p = join_small(pairs, many, ["a"]).withColumn("salt", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
    rows = p.select(F.col("b").alias("sid"), "a", "salt").union(
        p.select(F.col("a").alias("sid"), "a", "salt").distinct())
    need = rows.join(reps.where("doc_id is not null").select("sid", "doc_id"), "sid")
    text = docs.join(need, "doc_id").select("a", "salt", "sid", "text")
    text = text.repartition("a", "salt").sortWithinPartitions("a", "salt", (F.col("sid") != F.col("a")).cast("int"))
    return written(text.mapInArrow(_verify(k, num, den), "a long, b long"), "links")


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id",
                    text_col: str = "text", n2: int = N2, k2: int = K2) -> DataFrame:
    """doc_id, n_shingles, component_id: documents whose word k-gram sets have
    Jaccard similarity num/den or more are linked."""
    docs = python_ready(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))
    sets = written(docs.mapInArrow(_scan_sets(k), "doc_id long, n_shingles long, sid long, cells binary"), "sets")
    reps = written(sets.where("sid is not null").groupBy("sid").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("cells").alias("cells")), "reps")
    signed = docs.select("text").mapInArrow(_scan_signatures(k, num, den, n2, k2), "sig long, sid long")
    by_sig = signed.repartition("sig").dropDuplicates(["sig", "sid"])
    by_sig = by_sig.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("sig"))).where("n > 1")
    member = written(by_sig, "signatures")
    weight = member.groupBy("sid").agg(F.sum("n").alias("w"))
    member = written(member.join(weight, "sid"), "weighted")
    pivot = member.groupBy("sig").agg(F.max(F.struct("w", "sid"))["sid"].alias("a"))
    pairs = member.join(pivot, "sig").where("a <> sid").select("a", F.col("sid").alias("b")).distinct()
    links = _verified(docs, pairs, reps, k, num, den)
    # what the pivots did not connect: signatures of several components
    comp = connected_components(links).toDF("sid", "c")
    held = written(member.join(comp, "sid", "left").select("sig", "sid", F.coalesce("c", "sid").alias("c")), "held")
    split = held.groupBy("sig").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 <> c1").select("sig")
    rest = written(held.join(split, "sig").select("sig", "sid"), "rest")
    links = links.union(_links_in_groups(docs, rest, reps, k, num, den))
    ids = reps.where("doc_id is not null").select("sid", "doc_id")
    edges = links.join(ids.toDF("a", "da"), "a").join(ids.toDF("b", "db"), "b").select(
        F.col("da").alias("a"), F.col("db").alias("b"))
    comp = connected_components(edges).toDF("rep", "component")
    ids = ids.toDF("sid", "rep").join(comp, "rep", "left").select(
        "sid", F.coalesce("component", "rep").alias("component"))
    return sets.join(ids, "sid", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs`` left when one document of each component stays
    (the one of smallest id; of rows equal in id and text one; different texts
    under that id all stay, and so do rows without id)."""
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **kw)
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias("_kept_id")).distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    held = docs.select(F.col(f"`{id_col}`").alias("_id"), F.md5(F.col(f"`{text_col}`")).alias("_text"), row)
    one = held.join(kept, held["_id"] == kept["_kept_id"], "left_semi").dropDuplicates(["_id", "_text"])
    return one.union(held.where("_id is null")).select("row.*")


def op3_ngram_jaccard_join(spark, sf_dir):
    return near_duplicates(documents(spark, sf_dir), k=3, num=90, den=100)

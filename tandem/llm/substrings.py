"""Substring dedup with a compressed FM-index per shard (operator 2).

A window is SPAN consecutive words.  Words covered by a window whose word
sequence also starts earlier (smaller id, or same document, earlier start) are
removed; windows are judged on the input.

Routing.  The smallest hash among a window's KGRAM-word grams is its anchor;
consecutive windows with the same anchor form a segment (about nine windows).
Equal windows have equal anchors, so windows need comparing only among
segments of one anchor.  Tasks send, for each segment, anchor, content hash
and place, packed by bucket, through one exchange; equal segments are collapsed
to their first occurrence before the exchange (in the task) and after it.
Anchors seen more than once name the segments worth indexing; only their words
are fetched and sent to the shards.

Shards.  A shard concatenates its segments in document order, builds the
index, and streams every segment through it: backward search in the wavelet
matrix gives the matching statistics up to SPAN words; those reaching SPAN with
two or more occurrences are reported, and all but the first occurrence are
removed.  Shards are sized by the counted words.  Segments of an anchor with
very many different contexts are cut into their single windows, which are
dealt to shards by content.

Texts are moved twice by id, packed with zstandard.

Cases: null and empty texts have no words; documents shorter than SPAN keep
all; rows equal in id and text are one document and get equal results; rows of
one id and different texts count as different documents, ordered by a hash of
the text; a null id orders before all; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.llm.common import _mix, documents, ngrams, python_ready, steps, words, written
from tandem.llm.fmindex import FMIndex

SPAN, KGRAM = 20, 6
#: Segments a task gathers before it sends them.
GATHER = 400_000
#: Text bytes a routing bucket stands for, and words an index shard holds, on average.
BUCKET_BYTES, SHARD_WORDS = 8 << 20, 200_000
#: Different segments of an anchor above which its windows are dealt singly.
HOT_ANCHOR = 1000
_U = np.uint64
_NO_ID = -(1 << 63)


def segments(h: np.ndarray, doc: np.ndarray, span: int = SPAN, k: int = KGRAM):
    """Segments of windows with one anchor: (document, first word within the
    document, number of windows, anchor, content hash, first word in ``h``)."""
    z = np.zeros(0, np.int64)
    if len(h) < span:
        return z, z, z, z.view(_U), z.view(_U), z
    g, _ = ngrams(h, doc, k)
    m, w = len(h) - span + 1, span - k + 1
    ok = doc[:m] == doc[span - 1:]
    best, at = g[:m].copy(), np.arange(m)
    for j in range(1, w):
        x = g[j:j + m]
        less = x < best
        best = np.where(less, x, best)
        at = np.where(less, np.arange(j, j + m), at)
    start = np.ones(m, bool)
    start[1:] = (at[1:] != at[:-1]) | (doc[1:m] != doc[:m - 1])
    first = np.flatnonzero(start & ok)
    run = np.append(np.flatnonzero(start | ~ok), m)
    n = run[np.searchsorted(run, first, "right")] - first
    with np.errstate(over="ignore"):
        # the content: a polynomial over the segment's words, by prefix sums
        from tandem.llm.common import _powers
        up, down = _powers(len(h) + 1)
        pre = np.concatenate((np.zeros(1, _U), np.cumsum(h * up[:len(h)], dtype=_U)))
        content = _mix((pre[first + n + span - 1] - pre[first]) * down[first] + n.astype(_U))
    head = np.searchsorted(doc, doc[first])
    return doc[first], first - head, n, best[first], content, first


_KEY = ["bucket", "blob", "doc_id", "tk", "a", "m"]
_ROUTED = "bucket int, blob binary, doc_id long, tk int, a int, m int"
_REC = np.dtype([("anchor", "<u4"), ("content", "<u8"), ("doc", "<i8"), ("tk", "<i4"), ("a", "<i4"), ("m", "<i4")])


def _out(cols, n):
    return pa.record_batch([pa.array(cols.get(c, [None] * n), t) for c, t in zip(
        _KEY, (pa.int32(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32()), strict=True)], _KEY)


def _pack(rec: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(rec[f]).tobytes() for f in _REC.names))


def _unpack(blobs) -> np.ndarray:
    out = []
    for b in blobs:
        raw = zstandard.ZstdDecompressor().decompress(b)
        n, at = len(raw) // _REC.itemsize, 0
        rec = np.empty(n, _REC)
        for f in _REC.names:
            size = n * _REC[f].itemsize
            rec[f] = np.frombuffer(raw[at:at + size], _REC[f])
            at += size
        out.append(rec)
    return np.concatenate(out)


def _first_seen(rec: np.ndarray):
    """The records in order of (anchor, content, place) and a mask of the first
    of each content."""
    rec = rec[np.lexsort((rec["a"], rec["tk"], rec["doc"], rec["content"], rec["anchor"]))]
    first = np.ones(len(rec), bool)
    first[1:] = (rec["anchor"][1:] != rec["anchor"][:-1]) | (rec["content"][1:] != rec["content"][:-1])
    return rec, first


def _again(rec, first):
    """Later occurrences of a content (a repeated row is no later occurrence)."""
    group = np.flatnonzero(first)[np.cumsum(first) - 1] if len(rec) else np.zeros(0, np.int64)
    same = (rec["doc"] == rec["doc"][group]) & (rec["tk"] == rec["tk"][group]) & (rec["a"] == rec["a"][group])
    return ~first & ~same


def _removals(rec):
    return _out({"doc_id": rec["doc"], "tk": rec["tk"], "a": rec["a"], "m": rec["m"]}, len(rec))


def _ids(part):
    doc = part.column("doc_id").fill_null(_NO_ID).to_numpy()
    return doc, part.column("tk").to_numpy()


def _route(buckets: int):
    def run(batches):
        held, size = [], 0

        def flush():
            rec, first = _first_seen(np.concatenate(held))
            again = rec[_again(rec, first)]
            if len(again):
                yield _removals(again)
            # equal segments in one task: their first place, and one more to show that the anchor repeats
            second = np.zeros(len(rec), bool)
            second[1:] = first[:-1] & ~first[1:]
            rec = rec[first | second]
            b = (rec["anchor"].astype(np.int64) * buckets) >> 32
            rec, b = rec[order := np.lexsort((rec["a"], rec["doc"], b))], b[order]
            cut = np.flatnonzero(np.r_[True, b[1:] != b[:-1], True])
            blobs = [_pack(rec[i:j]) for i, j in zip(cut[:-1], cut[1:], strict=True)]
            yield _out({"bucket": b[cut[:-1]].astype(np.int32), "blob": blobs}, len(blobs))

        for part, data, offs in steps(batches):
            _, _, doc, h = words(data, offs)
            d, a, n, anchor, content, _ = segments(h, doc)
            ids, tk = _ids(part)
            rec = np.empty(len(d), _REC)
            # anchors are minima, so small: mixed again they spread evenly over the buckets
            rec["anchor"], rec["content"] = (_mix(anchor) >> _U(32)).astype(np.uint32), content ^ (anchor << _U(32))
            rec["doc"], rec["tk"], rec["a"], rec["m"] = ids[d], tk[d], a, n
            if len(rec):
                held.append(rec)
                size += len(rec)
            if size >= GATHER:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()
    return run


def _collapse(batches):
    """Rows in order of bucket: removals of later equal segments, and the first
    segments of anchors that repeat (m negative where the anchor is hot)."""
    blobs, bucket = [], None

    def close():
        rec, first = _first_seen(_unpack(blobs))
        again = rec[_again(rec, first)]
        yield _out({"bucket": [-1] * len(again), "doc_id": again["doc"], "tk": again["tk"], "a": again["a"],
                    "m": again["m"]}, len(again))
        anchor, inv, n = np.unique(rec["anchor"], return_inverse=True, return_counts=True)
        kinds = np.bincount(inv, first, len(anchor))
        keep = first & (n[inv] > 1)
        some, hot = rec[keep], kinds[inv[keep]] > HOT_ANCHOR
        yield _out({"bucket": (some["anchor"] >> 1).astype(np.int32), "doc_id": some["doc"], "tk": some["tk"],
                    "a": some["a"], "m": np.where(hot, -some["m"], some["m"])}, len(some))

    for b in batches:
        rows = zip(b.column("bucket").to_pylist(), b.column("blob"), strict=True)
        for k, blob in rows:
            if k != bucket and blobs:
                yield from close()
                blobs = []
            bucket = k
            blobs.append(blob.as_py())
    if blobs:
        yield from close()


def _packed(batches):
    z = zstandard.ZstdCompressor(level=1)
    for b in batches:
        text = [z.compress(("" if t is None else t).encode()) for t in b.column("text").to_pylist()]
        yield pa.record_batch([b.column("doc_id"), b.column("tk"), pa.array(text, pa.binary())], ["doc_id", "tk", "z"])


def _unpacked(batches):
    """The batches with ``z`` as the column ``text`` again, some rows at a time."""
    for b in batches:
        for s in range(0, len(b), 128):
            part = b.slice(s, 128)
            text = [zstandard.ZstdDecompressor().decompress(x.as_py()) for x in part.column("z")]
            arrays = [part.column(c) for c in part.schema.names if c != "z"] + [pa.array(text, pa.large_binary()).cast(pa.large_string())]
            yield pa.record_batch(arrays, [c for c in part.schema.names if c != "z"] + ["text"])


_SHARD = "shard int, blob binary"


def _fetch(shards: int):
    """Words of the wanted segments (``segs``: anchor, a, m), packed by shard."""
    def run(batches):
        held: dict = {}
        size = 0

        def flush():
            for s, parts in sorted(held.items()):
                head = np.array([p[:4] for p in parts], np.int64)
                raw = head.tobytes() + b"".join(p[4].tobytes() for p in parts)
                yield pa.record_batch([pa.array([s], pa.int32()), pa.array(
                    [np.int64(len(head)).tobytes() + zstandard.ZstdCompressor(level=1).compress(raw)], pa.binary())],
                    ["shard", "blob"])
            held.clear()

        for part, data, offs in steps(_unpacked(batches)):
            _, _, doc, h = words(data, offs)
            head = np.searchsorted(doc, np.arange(len(offs)))
            ids, tk = _ids(part)
            for i, segs in enumerate(part.column("segs").to_pylist()):
                for s in {(x["bucket"], x["a"], x["m"]) for x in segs}:
                    anchor, a, m = s
                    at = head[i] + a
                    if m > 0:
                        piece = h[at:at + m + SPAN - 1]
                        shard = int(_mix(np.array([anchor], _U))[0]) % shards
                        held.setdefault(shard, []).append((int(ids[i]), int(tk[i]), a, len(piece), piece))
                        size += len(piece)
                    else:
                        for j in range(-m):
                            piece = h[at + j:at + j + SPAN]
                            shard = int(ngrams(piece, np.zeros(SPAN, int), SPAN)[0][0]) % shards
                            held.setdefault(shard, []).append((int(ids[i]), int(tk[i]), a + j, SPAN, piece))
                            size += SPAN
            if size > 1 << 20:
                yield from flush()
                size = 0
        yield from flush()
    return run


def search_shard(head: np.ndarray, h: np.ndarray, span: int = SPAN):
    """``head``: (document, tie key, first word, length) of segments, ``h``
    their word hashes one after another.  The windows that occur earlier, as
    rows (document, tie key, first word)."""
    size = head[:, 3]
    begin = np.concatenate(([0], np.cumsum(size)))[:-1]
    order = np.lexsort((head[:, 2], head[:, 1], head[:, 0]))
    head, begin, size = head[order], begin[order], size[order]
    n = int(size.sum()) + len(size)
    at = np.concatenate(([0], np.cumsum(size + 1)))[:-1]
    seg = np.repeat(np.arange(len(size)), size)
    inner = np.arange(len(seg)) - np.repeat(np.cumsum(size) - size, size)
    vocab, code = np.unique(h, return_inverse=True)
    text = np.zeros(n, np.int64)
    text[at[seg] + inner] = code[begin[seg] + inner] + 1
    index = FMIndex(text, len(vocab) + 1, max(32, span))
    last = inner >= span - 1
    ends, seg, place = (at[seg] + inner)[last], seg[last], (inner - span + 1)[last]
    found = []
    for s in range(0, len(ends), 1 << 17):
        part = slice(s, s + (1 << 17))
        length, lo = index.matching_statistics(text, ends[part], span)
        hit = length == span
        found.append((lo[hit], seg[part][hit], place[part][hit]))
    lo, seg, place = (np.concatenate(x) for x in zip(*found, strict=True))
    # rows of one interval are occurrences of one window, in document order
    order = np.argsort(lo, kind="stable")
    lo, seg, place = lo[order], seg[order], place[order]
    group = np.flatnonzero(np.r_[True, lo[1:] != lo[:-1]]) if len(lo) else np.zeros(0, np.int64)
    first = np.repeat(group, np.diff(np.append(group, len(lo))))
    where = np.stack((head[seg, 0], head[seg, 1], head[seg, 2] + place), 1) if len(lo) else np.zeros((0, 3), np.int64)
    return where[(where != where[first]).any(1)]


def _search(batches):
    blobs, shard = [], None

    def close():
        heads, hashes = [], []
        for b in blobs:
            n = int(np.frombuffer(b[:8], np.int64)[0])
            raw = zstandard.ZstdDecompressor().decompress(b[8:])
            heads.append(np.frombuffer(raw[:n * 32], np.int64).reshape(n, 4))
            hashes.append(np.frombuffer(raw[n * 32:], _U))
        hit = search_shard(np.concatenate(heads), np.concatenate(hashes))
        # neighbouring windows as one row
        hit = hit[np.lexsort((hit[:, 2], hit[:, 1], hit[:, 0]))]
        new = np.ones(len(hit), bool)
        new[1:] = (hit[1:, 0] != hit[:-1, 0]) | (hit[1:, 1] != hit[:-1, 1]) | (hit[1:, 2] != hit[:-1, 2] + 1)
        at = np.flatnonzero(new)
        m = np.diff(np.append(at, len(hit)))
        yield _out({"bucket": [-1] * len(at), "doc_id": hit[at, 0], "tk": hit[at, 1].astype(np.int32),
                    "a": hit[at, 2].astype(np.int32), "m": m.astype(np.int32)}, len(at)).select(["doc_id", "tk", "a", "m"])

    for b in batches:
        for k, blob in zip(b.column("shard").to_pylist(), b.column("blob"), strict=True):
            if k != shard and blobs:
                yield from close()
                blobs = []
            shard = k
            blobs.append(blob.as_py())
    if blobs:
        yield from close()


def _rewrite(batches):
    for part, data, offs in steps(_unpacked(batches)):
        start, stop, doc, h = words(data, offs)
        head = np.searchsorted(doc, np.arange(len(offs)))
        raw = data.tobytes()
        n, gone, sha, texts = np.diff(head), [], [], []
        for i, cuts in enumerate(part.column("cuts").to_pylist()):
            k = int(n[i])
            cover = np.zeros(k + 1, np.int32)
            for c in cuts or ():
                cover[c["a"]] += 1
                cover[c["a"] + c["m"] + SPAN - 1] -= 1
            keep = np.cumsum(cover[:-1]) == 0
            s, e = start[head[i]:head[i + 1]][keep], stop[head[i]:head[i + 1]][keep]
            kept = b" ".join([raw[x:y] for x, y in zip(s.tolist(), e.tolist(), strict=True)])
            gone.append(k - len(s))
            sha.append(hashlib.sha256(kept).hexdigest())
            texts.append(kept)
        yield pa.record_batch([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha),
                               pa.array(texts, pa.large_binary()).cast(pa.large_string()).cast(pa.string())],
                              ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256, kept (the text)."""
    narrow = python_ready(docs).select(F.col(id_col).cast("long").alias("doc_id"),
                                       F.pmod(F.xxhash64(text_col), F.lit(1 << 31)).cast("int").alias("tk"), F.col(text_col).alias("text"))
    total = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(32, total // BUCKET_BYTES)
    routed = narrow.mapInArrow(_route(buckets), _ROUTED)
    routed = written(routed, "routed")
    early = routed.where("bucket is null").select("doc_id", "tk", "a", "m")
    held = routed.where("bucket is not null").select("bucket", "blob").repartition("bucket").sortWithinPartitions("bucket")
    held = written(held.mapInArrow(_collapse, _ROUTED), "collapsed")
    later = held.where("bucket = -1").select("doc_id", "tk", "a", "m")
    wanted = held.where("bucket >= 0").select("doc_id", "tk", "bucket", "a", "m")
    n_words = wanted.agg(F.sum(F.abs("m") + SPAN - 1)).first()[0] or 0
    shards = max(16, n_words // SHARD_WORDS)
    packed = narrow.mapInArrow(_packed, "doc_id long, tk int, z binary").withColumn(
        "k", F.coalesce("doc_id", F.lit(_NO_ID)))
    segs = wanted.groupBy("doc_id", "tk").agg(F.collect_list(F.struct("bucket", "a", "m")).alias("segs"))
    segs = segs.withColumnRenamed("doc_id", "k")
    texts = packed.join(segs, ["k", "tk"]).select("doc_id", "tk", "z", "segs")
    pieces = texts.mapInArrow(_fetch(shards), _SHARD).repartition("shard").sortWithinPartitions("shard")
    found = written(pieces.mapInArrow(_search, "doc_id long, tk int, a int, m int"), "repeats")
    cuts = early.union(later).union(found).groupBy("doc_id", "tk").agg(
        F.collect_list(F.struct("a", "m")).alias("cuts")).withColumnRenamed("doc_id", "k")
    return packed.join(cuts, ["k", "tk"], "left").select("doc_id", "z", "cuts").mapInArrow(
        _rewrite, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")


def op2_substring_dedup(spark, sf_dir):
    return remove_repeats(documents(spark, sf_dir)).drop("kept")

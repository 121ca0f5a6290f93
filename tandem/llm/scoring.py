"""Language-model scoring with a weighted backoff automaton (operator 12).

A trigram model with hierarchical Dirichlet smoothing is learned from all
training documents, with every n-gram kept:

    p(w)     = (c(w) + 0.5) / (N + 0.5 (V + 1))
    p(w|v)   = (c(vw) + m2 p(w)) / (c(v) + m2)
    p(w|uv)  = (c(uvw) + m3 p(w|v)) / (c(uv) + m3)

Each distribution sums to one over the V known tokens and one unknown token.
As an automaton, the contexts are states; a state's arcs are the n-grams seen
after it, weighted by the formula's value; its failure arc has the weight
m / (c + m) and leads to the context one word shorter.  A text is read once from
left to right: at each token the state follows failure arcs until it has an arc
for the token, and the logarithms of all weights on the way are added up.

Documents are read in blocks of BLOCK bytes.  A block sends the 64-bit keys of
its distinct n-grams, with their counts in its training documents, to shards by
key; a shard adds them up and returns to each block the totals of the keys that
it sent.  So a block gets just the part of the automaton that its texts can
visit, whatever the model's size; no task or driver holds the model, and a hot
n-gram is one entry a block.  Within the block all texts advance together, one
token a step; long texts are cut into lanes, each starting in the state that the
two words before it determine.

The documents are read twice, for keys and for texts, and must come in the same
order both times, as a table read from files does.  Blocks check this and stop
the job otherwise; write other inputs to a table first.

Cases: null and empty texts are their end token alone; a null id is no held-out
id; tied ids and repeated rows count each and score alike; texts of any length
are read whole (a block holds at least one document); without training documents
every score is 0; an empty table gives no rows; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.llm.common import _BASE, _mix, LOWER_CODE, documents, python_ready, steps, words, written

#: Dirichlet strengths of the bigram and trigram level.
M2, M3 = 1000.0, 100.0
#: Text bytes of a block, text bytes whose n-grams a shard holds, tokens of a lane.
BLOCK, SHARD, LANE = 4 << 20, 16 << 20, 256
_U = np.uint64
START, END = (_mix(np.array([x], np.uint64))[0] for x in (0x5354415254, 0x454E44))


# ------------------------------------------------------------------- packing

def pack(x: np.ndarray) -> bytes:
    """Numbers as byte planes, compressed: high planes of small numbers vanish."""
    flat = np.ascontiguousarray(x.astype(np.uint64).view(np.uint8).reshape(-1, 8).T)
    return pa.compress(flat.tobytes(), codec="zstd", asbytes=True) if len(x) else b""


def unpack(raw: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint64)
    flat = np.frombuffer(pa.decompress(raw, 8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(flat.reshape(8, -1).T).reshape(-1).view(np.uint64)


# -------------------------------------------------------------------- blocks

class Block:
    """Some documents' token sequences (start mark, words, end mark) and their
    distinct n-grams."""

    def __init__(self, h: np.ndarray, n: np.ndarray):
        """``h``: the hashes of all words; ``n``: the number of each document's."""
        doc = np.repeat(np.arange(len(n)), n)
        self.n = n + 1                                   # tokens a document
        self.first = np.cumsum(n + 2) - (n + 2)          # place of its start mark
        seq = np.empty(int((n + 2).sum()), np.uint64)
        seq[self.first] = START
        seq[self.first + n + 1] = END
        seq[np.arange(len(h)) + 2 * doc + 1] = h
        self.seq = seq
        self.doc = np.repeat(np.arange(len(n)), n + 2)
        token = np.ones(len(seq), bool)
        token[self.first] = False
        self.word = np.flatnonzero(token)                # all tokens
        token[self.first + 1] = False
        self.third = np.flatnonzero(token)               # those with two before them
        with np.errstate(over="ignore"):
            two = seq[self.word - 1] * _U(_BASE) + seq[self.word]
            three = (seq[self.third - 2] * _U(_BASE) + seq[self.third - 1]) * _U(_BASE) + seq[self.third]
        # the order stands in the two highest bits, so the three parts together are sorted
        each = [np.unique(_mix(x) >> _U(2) | _U(k << 62), return_inverse=True)
                for k, x in ((1, seq[self.word]), (2, two), (3, three))]
        self.key = np.concatenate([u for u, _ in each])
        self.of = np.concatenate([of + at for (_, of), at in zip(each, np.cumsum([0] + [len(u) for u, _ in each]), strict=False)])
        #: a place where each n-gram ends
        self.at = np.empty(len(self.key), np.int64)
        self.at[self.of] = np.concatenate((self.word, self.word, self.third))

    def training_counts(self, learns: np.ndarray) -> np.ndarray:
        at = np.concatenate((self.word, self.word, self.third))
        return np.bincount(self.of, learns[self.doc[at]], len(self.key)).astype(np.int64)

    def parts(self, shards: int) -> list[np.ndarray]:
        """The numbers of each shard's keys: an equal range of each order."""
        low = [(k << 62) + -(-(i << 62) // shards) for k in (1, 2, 3) for i in range(shards)]
        cut = np.append(np.searchsorted(self.key, np.array(low, np.uint64)), len(self.key))
        return [np.concatenate([np.arange(cut[j], cut[j + 1]) for j in (i, i + shards, i + 2 * shards)]) for i in range(shards)]


def _blocks(batches, take):
    """(number, what ``take`` makes of each step) of each block of a partition."""
    block = TaskContext.get().partitionId() << 32
    held, size = [], 0
    for rows, data, offs in steps(batches):
        held.append(take(rows, data, offs))
        size += len(data)
        if size >= BLOCK:
            yield block, held
            block, held, size = block + 1, [], 0
    if held:
        yield block, held


def _hashed(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All words' hashes, and each document's number of words."""
    _, _, doc, h = words(data, offs, code=LOWER_CODE)
    return h, np.bincount(doc, minlength=len(offs) - 1)


def _out(rows) -> np.ndarray:
    return rows.column("held_out").to_numpy(zero_copy_only=False)


def _send_keys(shards: int):
    def run(batches):
        for number, held in _blocks(batches, lambda rows, data, offs: (_out(rows), *_hashed(data, offs))):
            out, h, n = (np.concatenate(x) for x in zip(*held, strict=True))
            b = Block(h, n)
            n = b.training_counts(~out)
            rows = [(i, number, len(p), pack(np.diff(b.key[p], prepend=_U(0))), pack(n[p]))
                    for i, p in enumerate(b.parts(shards)) if len(p)]
            names = ["shard", "block", "size", "keys", "counts"]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
    return run


def _add_up(rows: pa.Table) -> pa.Table:
    """A shard's totals, returned for the keys of each block; and, as block -1,
    its numbers of training tokens and of distinct ones."""
    size = rows.column("size").to_numpy()
    with np.errstate(over="ignore"):
        key = [np.cumsum(unpack(k, n), dtype=np.uint64) for k, n in zip(rows.column("keys").to_pylist(), size, strict=True)]
    check = [int(np.bitwise_xor.reduce(k).view(np.int64)) for k in key]
    count = np.concatenate([unpack(c, n) for c, n in zip(rows.column("counts").to_pylist(), size, strict=True)])
    key, of = np.unique(np.concatenate(key), return_inverse=True)
    total = np.bincount(of, count.astype(np.float64)).astype(np.int64)
    cut = np.concatenate(([0], np.cumsum(size)))
    word = key >> _U(62) == 1
    stats = np.array([total[word].sum(), (total[word] > 0).sum()])
    m = rows.num_rows
    return pa.table({
        "block": pa.array([*rows.column("block").to_pylist(), -1], pa.int64()),
        "shard": pa.array([rows.column("shard")[0].as_py()] * (m + 1), pa.int32()),
        "check": pa.array([*check, 0], pa.int64()),
        "n_tokens": pa.array([0] * m + [int(stats[0])], pa.int64()), "n_words": pa.array([0] * m + [int(stats[1])], pa.int64()),
        "totals": pa.array([*(pack(total[of[a:b]]) for a, b in zip(cut[:-1], cut[1:], strict=True)), b""], pa.binary())})


# ----------------------------------------------------------------- automaton

class Automaton:
    """The states and arcs that a block's texts can visit.

    State 0 has no context; state 1 + i has word i as context (the last word is
    the start mark), the states after these have the block's known bigrams."""

    def __init__(self, b: Block, total: np.ndarray, n_tokens: int, n_words: int, m2: float = M2, m3: float = M3):
        order = (b.key >> _U(62)).astype(np.int64)
        place = b.at
        number = np.cumsum(order == 1) - 1                               # of a word among words
        one = np.full(len(b.seq), -1)
        one[b.word] = number[b.of[:len(b.word)]]
        c1 = total[order == 1]
        self.start = len(c1)
        one[b.first] = self.start
        self.one = one
        end = one[b.first[0] + b.n[0]]
        c1 = np.append(c1, c1[end])                                      # as many starts as ends
        self.known = c1[:-1] > 0
        p1 = (c1[:-1] + 0.5) / (n_tokens + 0.5 * (n_words + 1))
        self.root = np.log10(p1)
        words_ = len(c1)
        # known bigrams: arcs of word states, and states
        two = np.flatnonzero((order == 2) & (total > 0))
        v, w, c2 = one[place[two] - 1], one[place[two]], total[two]
        p2 = (c2 + m2 * p1[w]) / (c1[v] + m2)
        state = np.zeros(len(total), np.int64)
        state[two] = 1 + words_ + np.arange(len(two))
        self.two = np.full(len(b.seq), 0)
        self.two[b.word] = state[b.of[len(b.word):2 * len(b.word)]]      # state after each place, 0 if none
        self.fail = np.concatenate(([0], np.zeros(words_, np.int64), 1 + w))
        self.fail_weight = np.concatenate(([0.0], np.log10(m2 / (c1 + m2)), np.log10(m3 / (c2 + m3))))
        self.scale = words_
        self.arcs2 = self._sorted(1 + v, w, np.log10(p2), state[two])
        # known trigrams: arcs of bigram states
        three = np.flatnonzero((order == 3) & (total > 0))
        at = place[three]
        low = self.two[at]                                               # the bigram that ends here
        p3 = (total[three] + m3 * p2[low - 1 - words_]) / (c2[self.two[at - 1] - 1 - words_] + m3)
        self.arcs3 = self._sorted(self.two[at - 1], one[at], np.log10(p3), low)

    def _sorted(self, state, w, weight, target):
        key = state * self.scale + w
        order = np.argsort(key)
        return key[order], weight[order], target[order]

    def _follow(self, arcs, state, w):
        """(found, weight, target) of the arcs of each state for its word."""
        key, weight, target = arcs
        if not len(key):
            return np.zeros(len(state), bool), np.zeros(0), np.zeros(0, np.int64)
        k = state * self.scale + w
        at = np.minimum(np.searchsorted(key, k), len(key) - 1)
        ok = key[at] == k
        return ok, weight[at[ok]], target[at[ok]]

    def read(self, state: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One token for each of many texts: (new states, log10 weights)."""
        out, state = np.zeros(len(w)), state.copy()
        new = np.zeros(len(w), np.int64)
        left = np.arange(len(w))
        for arcs, least in ((self.arcs3, self.scale), (self.arcs2, 0)):
            at = left[state[left] > least]
            ok, weight, target = self._follow(arcs, state[at], w[at])
            hit, miss = at[ok], at[~ok]
            out[hit] += weight
            new[hit] = target
            out[miss] += self.fail_weight[state[miss]]
            state[miss] = self.fail[state[miss]]
            left = left[new[left] == 0]
        out[left] += self.root[w[left]]
        new[left] = 1 + w[left]
        return new, out

    def scores(self, b: Block) -> np.ndarray:
        """log10 probability of each text: lanes of at most LANE tokens advance
        together."""
        lanes = -(-b.n // LANE)
        doc = np.repeat(np.arange(len(b.n)), lanes)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = b.first[doc] + 1 + nth * LANE
        size = np.minimum(LANE, b.n[doc] - nth * LANE)
        before = at - 1
        state = np.where(self.two[before] > 0, self.two[before], 1 + self.one[before])
        total = np.zeros(len(doc))
        order = np.argsort(-size, kind="stable")
        alive = np.searchsorted(-size[order], -np.arange(LANE), "left")  # lanes longer than t
        for t in range(int(size.max(initial=0))):
            some = order[:alive[t]]
            state[some], add = self.read(state[some], self.one[at[some] + t])
            total[some] += add
        return np.bincount(doc, total, len(b.n))


def _send_texts(batches):
    def take(rows, data, offs):
        raw = data.tobytes()
        return (pa.array(rows.column("id").to_pylist(), rows.column("id").type), _out(rows).tolist(), len(raw),
                pa.compress(raw, codec="zstd", asbytes=True), pack(offs), len(offs))

    for number, held in _blocks(batches, take):
        ids, out, size, text, offs, rows = zip(*held, strict=True)
        ids = pa.concat_arrays(ids)
        lists = [pa.array([list(x)], pa.list_(t)) for x, t in (
            (sum(out, []), pa.bool_()), (size, pa.int64()), (text, pa.binary()), (offs, pa.binary()), (rows, pa.int64()))]
        yield pa.record_batch([pa.array([number], pa.int64()), pa.ListArray.from_arrays([0, len(ids)], ids), *lists],
                              ["block", "ids", "held_out", "size", "text", "offs", "rows"])


def _traverse(shards: int, n_tokens: int, n_words: int, m2: float, m3: float):
    def run(texts: pa.Table, totals: pa.Table) -> pa.Table:
        row = {c: texts.column(c)[0].as_py() for c in ("held_out", "size", "text", "offs", "rows")}
        ids = texts.column("ids").combine_chunks().flatten()
        h = [_hashed(np.frombuffer(pa.decompress(t, n, codec="zstd", asbytes=True), np.uint8), unpack(o, m).astype(np.int64))
             for t, n, o, m in zip(row["text"], row["size"], row["offs"], row["rows"], strict=True)]
        b = Block(*(np.concatenate(x) for x in zip(*h, strict=True)))
        parts, total, seen = b.parts(shards), np.zeros(len(b.key), np.int64), 0
        for shard, check, packed in zip(*(totals.column(c).to_pylist() for c in ("shard", "check", "totals")), strict=True):
            p = parts[shard]
            if not len(p) or int(np.bitwise_xor.reduce(b.key[p]).view(np.int64)) != check:
                raise RuntimeError("the documents came in another order when read again; write them to a table first")
            total[p] = unpack(packed, len(p)).astype(np.int64)
            seen += len(p)
        if seen != len(b.key):
            raise RuntimeError("the documents came in another order when read again; write them to a table first")
        auto = Automaton(b, total, n_tokens, n_words, m2, m3)
        token = auto.one[b.word]
        of = b.doc[b.word]
        return pa.table({
            "id": ids, "held_out": pa.array(row["held_out"], pa.bool_()), "n_tokens": pa.array(b.n, pa.int64()),
            "n_known": pa.array(np.bincount(of, auto.known[token], len(b.n)).astype(np.int64)),
            "train_tokens": pa.array(np.full(len(b.n), n_tokens), pa.int64()),
            "base_score": pa.array(np.bincount(of, auto.root[token], len(b.n))), "score": pa.array(auto.scores(b))})
    return run


def held_out(id_col: Column) -> Column:
    """The fold that the model never learns from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def scored(docs: DataFrame, held: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
           m2: float = M2, m3: float = M3) -> DataFrame:
    """One row a document: id, held_out, n_tokens, n_known (tokens seen in
    training), train_tokens, base_score (unigrams) and score, both log10.  The
    model learns from the documents outside ``held``."""
    python_ready(docs)
    one = F.col(f"`{id_col}`")
    rows = docs.select(one.alias("id"), (held_out(one) if held is None else held).alias("held_out"),
                       F.col(f"`{text_col}`").alias("text"))
    kind = dict(rows.dtypes)["id"]
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`")))).first()[0] or 0
    shards = max(8, -(-size // SHARD))
    keys = rows.mapInArrow(_send_keys(shards), "shard int, block long, size long, keys binary, counts binary")
    totals = written(keys.groupBy("shard").applyInArrow(
        _add_up, "block long, shard int, check long, n_tokens long, n_words long, totals binary"), "totals")
    n = totals.where("block = -1").agg(F.sum("n_tokens"), F.sum("n_words")).first()
    texts = rows.mapInArrow(_send_texts, f"""block long, ids array<{kind}>, held_out array<boolean>,
                              size array<long>, text array<binary>, offs array<binary>, rows array<long>""")
    back = totals.where("block >= 0").select("block", "shard", "check", "totals")
    return texts.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(
        _traverse(shards, n[0] or 0, n[1] or 0, m2, m3),
        f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op12_lm_scoring(spark, sf_dir):
    return scored(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")

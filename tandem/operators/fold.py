"""Early stopping as an ordered fold in constant memory.

The epochs are range-partitioned and sorted by (run, epoch, loss), so a run may
be cut at partition borders, and each partition streams through a state of two
numbers (best loss, epochs since the last improvement).  What enters a partition
in the middle of a run is found beforehand:

* One pass gives the length and lowest loss of each partition's first and last
  run; all others are whole.
* The best loss that enters a segment lies between m, the lowest loss of the
  run before it, and m + min_delta: had it been larger, m would have improved
  on it.  So a segment's transition has few cases, by the first loss that
  improves on what enters; a second pass follows each case through the segment.
* The driver composes the cases along each cut run (at most two segments a
  partition, ``CASES`` cases each).  Where a segment has more cases and the
  entering loss needs one that was not followed, the pass is repeated with
  that segment's state, by then known exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.config import MIN_DELTA, PATIENCE
from tandem.session import cut_lineage, ship_package

CASES = 64


class Fold:
    """Early-stopping state; ``feed`` advances it over losses in order."""

    def __init__(self, patience: int, min_delta: float, best: float = np.inf, counter: int = 0, stopped: bool = False):
        self.patience, self.min_delta = patience, min_delta
        self.best, self.counter, self.stopped = best, counter, stopped

    def feed(self, v: np.ndarray) -> tuple[np.ndarray, int | None]:
        """Positions that write a checkpoint, and the position of the stop."""
        if self.stopped or not len(v):
            return np.empty(0, np.int64), None
        # an improvement is below every loss before it
        low = np.fmin(np.fmin.accumulate(np.append(self.best, v[:-1])), self.best)
        improved, best = [], self.best
        for i in np.flatnonzero(v < low).tolist():
            if v[i] < best - self.min_delta:
                improved.append(i)
                best = v[i]
        improved = np.array(improved, np.int64)
        rows = np.arange(len(v))
        nth = np.searchsorted(improved, rows, side="right")
        bests = np.append(self.best, v[improved])[nth]
        counters = rows - np.append(-1 - self.counter, improved)[nth]
        over = np.flatnonzero(counters >= self.patience)
        last = int(over[0]) if len(over) else len(v) - 1
        self.best, self.counter, self.stopped = float(bests[last]), int(counters[last]), bool(len(over))
        return np.flatnonzero(v[:last + 1] == bests[:last + 1]), last if len(over) else None


class Cases:
    """Transition of a segment for every best loss between ``low`` and
    ``low + min_delta``: the losses that can be the first to improve on it, each
    with the fold that starts there."""

    def __init__(self, patience: int, min_delta: float, low: float, most: int):
        self.args, self.most, self.n, self.lowest = (patience, min_delta), most, 0, np.inf
        top = low + min_delta
        top = top + 4 * np.spacing(top) if np.isfinite(top) else top
        self.start_below, self.all_below = np.nextafter(top - min_delta, np.inf), low - min_delta
        self.starts, self.open, self.complete = [], True, True

    def feed(self, v: np.ndarray) -> None:
        for *_, f in self.starts:
            f.feed(v)
        if self.open:
            low = np.fmin(np.fmin.accumulate(np.append(self.lowest, v[:-1])), self.lowest)
            for i in np.flatnonzero((v < low) & (v < self.start_below)).tolist():
                if len(self.starts) == self.most:
                    self.complete = self.open = False
                    break
                f = Fold(*self.args, best=float(v[i]))
                f.feed(v[i + 1:])
                self.starts.append((self.n + i, float(v[i]), f))
                if v[i] < self.all_below:
                    self.open = False
                    break
            self.lowest = float(np.fmin(self.lowest, np.fmin.reduce(v, initial=np.inf)))
        self.n += len(v)


def _slices(batches):
    """``part, run, epochs, losses`` of every stretch of one run in a batch."""
    for b in batches:
        if not b.num_rows:
            continue
        part, runs = b.column("part")[0].as_py(), pc.run_end_encode(b.column("run"))
        v = b.column("v").to_numpy(zero_copy_only=False).astype(np.float64)
        start = 0
        for run, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
            yield part, run, b.column("e").slice(start, end - start), v[start:end]
            start = end


def _edges(batches):
    """The first and the last run of a partition: rows and lowest loss."""
    part, found = None, []
    for part, run, _, v in _slices(batches):
        low = float(np.fmin.reduce(v, initial=np.inf))
        if found and found[-1][0] == run:
            _, n, was = found.pop()
            found.append((run, n + len(v), min(was, low)))
        else:
            found = found[:1] + [(run, len(v), low)]
    return part, found


def _sorted(epochs: DataFrame, key: str, epoch: str, val: str) -> DataFrame:
    s = cut_lineage(epochs.select(F.col(key).alias("run"), F.col(epoch).cast("int").alias("e"),
                                  F.col(val).cast("double").alias("v")).orderBy("run", "e", "v"))
    return s.withColumn("part", F.spark_partition_id())


def _step(entering: tuple, n: int, starts: list, complete: bool, patience: int, min_delta: float) -> tuple | None:
    """The state after a segment, None if it needs a case that was not followed."""
    best, counter, stopped = entering
    if stopped:
        return entering
    for at, v, *after in starts:
        if v < best - min_delta:
            return (best, patience, True) if counter + at >= patience else tuple(after)
    if not complete:
        return None
    return best, counter + n, counter + n >= patience


def _entering(srt: DataFrame, patience: int, min_delta: float, cases: int) -> dict:
    """``{partition: state}`` for partitions that begin inside a run."""
    run_type = srt.schema["run"].dataType.simpleString()

    def edges(batches):
        part, found = _edges(batches)
        if found:
            yield pa.RecordBatch.from_pylist([{"part": part, "place": i, "run": r, "n": n, "low": low}
                                              for i, (r, n, low) in enumerate(found)], schema=edge_schema)

    from pyspark.sql.pandas.types import to_arrow_type
    edge_schema = pa.schema([("part", pa.int32()), ("place", pa.int32()), ("run", to_arrow_type(srt.schema["run"].dataType)),
                             ("n", pa.int64()), ("low", pa.float64())])
    rows = srt.mapInArrow(edges, f"part int, place int, run {run_type}, n long, low double").collect()  # two a partition
    rows.sort(key=lambda r: (r.part, r.place))
    # a cut run: its segments in order, each with the lowest loss before it
    chains, low = [], np.inf
    for before, r in zip([None, *rows], rows):
        if before is not None and before.run == r.run:
            chains[-1].append((r.part, r.place, r.n, low))
        else:
            chains.append([(r.part, r.place, r.n, np.inf)])
            low = np.inf
        low = min(low, r.low)
    chains = [c for c in chains if len(c) > 1]
    known = {c[0][:2]: (np.inf, 0, False) for c in chains}
    followed: dict = {}
    while True:
        todo = {}
        for c in chains:
            for (part, place, n, _), after in zip(c, c[1:]):
                state = known[part, place]
                if (part, place) in followed:
                    state = _step(state, n, *followed[part, place], patience, min_delta)
                elif not state[2]:
                    state = None
                if state is None:
                    todo[part, place] = ("from", known[part, place])
                    todo.update({s[:2]: ("low", s[3]) for s in c[1:-1]
                                 if s[:2] > (part, place) and s[:2] not in followed})
                    break
                known[after[:2]] = state
        if not todo:
            return {part: known[part, place] for c in chains for part, place, *_ in c[1:]}
        for r in srt.mapInArrow(_follow(todo, patience, min_delta, cases),
                                "part int, place int, complete boolean, starts array<struct<at:long,v:double,best:double,"
                                "counter:long,stopped:boolean>>").collect():  # at most CASES starts a segment
            followed[r.part, r.place] = [tuple(s) for s in r.starts], r.complete


def _follow(todo: dict, patience: int, min_delta: float, cases: int):
    """Follows the cases of the segments in ``todo`` through their partition."""
    def run(batches):
        place, now, at, out, first = 0, object(), None, {}, True
        for part, run, _, v in _slices(batches):
            if first or run != now:
                place, now, first = place + (not first), run, False
                # the place of a run that is not the partition's first counts as last
                want = todo.get((part, min(place, 1)))
                at = None
                if want:
                    kind, given = want
                    at = Cases(patience, min_delta, given, cases) if kind == "low" else \
                        Exact(Fold(patience, min_delta, *given))
                    out[part, min(place, 1)] = at
            if at:
                at.feed(v)
        rows = [{"part": part, "place": place, "complete": c.complete,
                 "starts": [{"at": i, "v": v, "best": f.best, "counter": f.counter, "stopped": f.stopped}
                            for i, v, f in c.starts]} for (part, place), c in out.items()]
        start = pa.struct([("at", pa.int64()), ("v", pa.float64()), ("best", pa.float64()), ("counter", pa.int64()),
                           ("stopped", pa.bool_())])
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
            ("part", pa.int32()), ("place", pa.int32()), ("complete", pa.bool_()), ("starts", pa.list_(start))]))
    return run


class Exact:
    """A segment whose entering state is known: one case, which always applies."""

    complete = True

    def __init__(self, fold: Fold):
        self.fold = fold

    def feed(self, v: np.ndarray) -> None:
        self.fold.feed(v)

    @property
    def starts(self):
        return [(0, -np.inf, self.fold)]


def fold_slices(epochs: DataFrame, patience: int = PATIENCE, min_delta: float = MIN_DELTA, key: str = "run",
                epoch: str = "epoch", val: str = "val_loss", cases: int = CASES) -> DataFrame:
    """One row for each stretch of a run (at most an Arrow batch): ``key, place``
    (its order), ``n`` epochs, ``best`` loss after it, ``stop_epoch`` if the run
    stops in it, ``checkpoints``: its epochs that write one."""
    if min_delta < 0 or patience < 1:
        raise ValueError("min_delta must not be negative and patience at least 1")
    ship_package(epochs.sparkSession)
    srt = _sorted(epochs, key, epoch, val)
    entering = _entering(srt, patience, min_delta, cases)
    kind = srt.schema["run"].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    schema = pa.schema([("run", to_arrow_type(kind)), ("part", pa.int32()), ("nth", pa.int64()), ("n", pa.int64()),
                        ("best", pa.float64()), ("stop_epoch", pa.int32()), ("checkpoints", pa.list_(pa.int32()))])

    def run(batches):
        now, fold, nth = None, None, 0
        for part, name, e, v in _slices(batches):
            if fold is None or name != now:
                state = entering.get(part, ()) if fold is None else ()
                now, fold = name, Fold(patience, min_delta, *state)
            kept, stop = fold.feed(v)
            yield pa.RecordBatch.from_pylist([{
                "run": name, "part": part, "nth": nth, "n": len(v), "best": fold.best,
                "stop_epoch": None if stop is None else e[stop].as_py(), "checkpoints": e.take(pa.array(kept)).to_pylist()}],
                schema=schema)
            nth += 1
    out = srt.mapInArrow(run, f"run {kind.simpleString()}, part int, nth long, n long, best double, stop_epoch int, "
                              "checkpoints array<int>")
    return out.select(F.col("run").alias(key), F.struct("part", "nth").alias("place"), "n", "best", "stop_epoch", "checkpoints")


def stops(slices: DataFrame, key: str = "run") -> DataFrame:
    """Per run: epochs, stop epoch, best loss at the stop, number of checkpoints."""
    return slices.groupBy(key).agg(F.sum("n").alias("n_epochs"), F.max("stop_epoch").alias("stop_epoch"),
                                   F.max_by("best", "place").alias("best_loss"),
                                   F.sum(F.size("checkpoints")).alias("n_checkpoints"))

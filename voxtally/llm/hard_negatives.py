"""Hard negatives by anchor clusters that share a list of candidates sorted by an angular bound.

Anchors are clustered by direction. For a member u of a cluster with centre c and
greatest angle t between centre and member, the inner product with a candidate v is
at most ``|u| |v| cos(max(0, angle(v, c) - t))``; without ``|u|`` this bound is the
same for all members. So a cluster sorts candidates by it once, and each member walks
down that list until the bound falls below what it still needs, which certifies that
no later candidate can enter its result.

Candidates are stored in slices of bounded size that lie close to one centre; the same
bound over the slice's own spread decides which clusters meet it at all. Each
cluster first walks its most promising slice, which gives thresholds for the others.
Pieces of one cluster hold a bounded number of anchors, so a crowd of equal vectors is
spread over tasks. The centres are fitted on at most ``SAMPLE`` anchors; they change
what is skipped and never a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxtally.llm.workers import ready
from voxtally.session import cut_lineage

SAMPLE = 16384  # anchors that the centres are fitted on
MEMBERS, CENTRES = 256, 1024  # anchors a centre, centres at most
CHUNK_ROWS = 1024  # anchors of one cluster that one task holds
SLICE_ROWS = 8192  # candidates that one task holds
STEP_ROWS = 1024  # candidates scored between two looks at the bound
EXACT, LARGEST, NEVER = 1 << 53, 1 << 60, 1 << 62
POSITIVES = NEGATIVES = 5
SLACK = 1e-9  # relative room for rounding in the bounds
Centres = dict[int, np.ndarray]


def prepared(vectors: DataFrame, key: str = "vec_id", value: str = "embedding", label: str = "label", scale: int = 256) -> DataFrame:
    """``id, label, terms`` with floor(scale * x) of each component.

    Rows with a null key or label, and vectors that are null, empty or hold a null
    or non-finite component, are left out.
    """
    whole = F.forall(F.col(value), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(value).isNotNull() & (F.size(value) > 0)).filter(F.coalesce(whole, F.lit(False)))
    terms = F.transform(F.col(value), lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    return rows.select(F.col(key).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), terms.alias("terms"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The same rows in pieces of at least ``rows``, but for the last."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def fit_centres(vectors: np.ndarray, rounds: int = 10) -> np.ndarray:
    """Unit centres of spherical k-means over one set of vectors (zero vectors count for nothing)."""
    size = np.linalg.norm(vectors, axis=1)
    units = vectors[size > 0] / size[size > 0, None]
    k = min(CENTRES, -(-len(units) // MEMBERS))
    centres = units[np.random.default_rng(7).permutation(len(units))[:k]]
    for _ in range(rounds if k > 1 else 1):
        home = (units @ centres.T).argmax(axis=1) if k else np.empty(0, np.int64)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, units)
        length = np.linalg.norm(sums, axis=1)
        centres = np.where(length[:, None] > 0, sums / np.maximum(length, 1e-300)[:, None], centres)
    return centres


def _angles(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(vectors, axis=1)
    cosine = (vectors @ centres.T) / np.where(size > 0, size, 1)[:, None]
    return np.arccos(np.clip(cosine, -1, 1))


def _placed(rows: DataFrame, centres: Centres) -> DataFrame:
    """Rows with a number, their norm, and the nearest centre with the angle to it (-1 and pi where a length has no centres)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = np.diff(batch.column("terms").offsets.to_numpy())
            for width in np.unique(widths).tolist():
                own = batch.filter(pa.array(widths == width))
                terms = _matrix(own.column("terms"), width).astype(np.float64)
                norm, home, angle = np.linalg.norm(terms, axis=1), np.full(len(terms), -1), np.full(len(terms), np.pi)
                if norm.max() ** 2 >= LARGEST:
                    raise ArithmeticError("components are too large for inner products in 64 bits")
                if len(centres.get(width, ())):
                    every = _angles(terms, centres[width])
                    home, angle = every.argmin(axis=1), every.min(axis=1)
                added = [pa.array(np.full(len(terms), width)), pa.array(home), pa.array(angle), pa.array(norm)]
                yield pa.RecordBatch.from_arrays([*own.columns, *added], names=[*own.schema.names, "width", "home", "angle", "norm"])

    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "id", "label", "terms", "asked")
    return numbered.mapInArrow(run, "row bigint, id bigint, label bigint, terms array<bigint>, asked boolean, width bigint, home bigint, angle double, norm double")


def _slices(placed: DataFrame) -> DataFrame:
    """Runs of candidates near one centre: ``slice, width, home, spread`` (greatest angle), ``reach`` (greatest norm) and their rows as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId() << 32, 0
        for batch in _gathered(batches, SLICE_ROWS):
            keys = np.stack([batch.column(c).to_numpy() for c in ("width", "home")])
            heads = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)]))
            for first, end in zip(heads, np.append(heads[1:], batch.num_rows), strict=True):
                for at in range(int(first), int(end), SLICE_ROWS):
                    piece = batch.slice(at, min(SLICE_ROWS, int(end) - at))
                    width, home = int(keys[0, at]), int(keys[1, at])
                    terms = _matrix(piece.column("terms").combine_chunks(), width)
                    kind = next(k for k in (np.int16, np.int32, np.int64) if np.iinfo(k).min <= terms.min() and terms.max() <= np.iinfo(k).max)
                    numbers = np.stack([piece.column(c).to_numpy() for c in ("row", "id", "label")])
                    spread, reach = (float(piece.column(c).to_numpy().max()) for c in ("angle", "norm"))
                    row = [part + made, width, home, spread, reach, np.dtype(kind).str, numbers.tobytes(), terms.astype(kind).tobytes()]
                    made += 1
                    yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=["slice", "width", "home", "spread", "reach", "kind", "numbers", "terms"])

    parts = placed.count() // (8 * SLICE_ROWS) + 1
    order = ["width", "home", "angle", "row"]
    ranged = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return ranged.mapInArrow(run, "slice bigint, width bigint, home bigint, spread double, reach double, kind string, numbers binary, terms binary")


def _between(slices: DataFrame, centres: Centres) -> DataFrame:
    """``slice, width, reach, spread, other, apart``: the angle between a slice's centre and every centre of its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                known = centres.get(row["width"], np.empty((0, 0)))
                others, apart = np.array([-1]), np.array([0.0])
                if row["home"] >= 0:
                    others, apart = np.arange(len(known)), _angles(known[row["home"]][None, :], known)[0]
                n = others.size
                columns = [np.full(n, row[c]) for c in ("slice", "width", "reach", "spread")]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*columns, others, apart)], names=["slice", "width", "reach", "spread", "other", "apart"])

    meta = slices.select("slice", "width", "home", "reach", "spread")
    return meta.mapInArrow(run, "slice bigint, width bigint, reach double, spread double, other bigint, apart double")


def best_first(cluster: dict, piece: dict, keep: int) -> tuple[list[np.ndarray], int]:
    """Walk one sorted list for all members of a cluster: (member, window, row, id, score) of the results, and the rows scored.

    ``cluster`` has ``terms``, ``norm``, ``row``, ``label`` of the members and for each
    ``low``, ``high`` of its windows (one column a window); ``same`` tells whether
    candidates need the member's label or another. Within each window the ``keep``
    highest scores count, ties by smaller id.
    """
    bound = piece["norm"] * np.cos(np.maximum(0.0, piece["angle"] - cluster["angle"]))
    order = np.argsort(-bound, kind="stable")
    members, windows = cluster["low"].shape
    least = cluster["low"].copy()  # what a candidate has to score to matter
    found = [np.empty(0, np.int64)] * 5
    active, scored = np.arange(members), 0
    for at in range(0, order.size, STEP_ROWS):
        top = bound[order[at]] * cluster["norm"][active]
        active = active[(top + SLACK * np.abs(top) + SLACK)[:] >= least[active].min(axis=1)]
        if not active.size:
            break
        some = order[at : at + STEP_ROWS]
        scores = cluster["terms"][active] @ piece["terms"][some].T
        scored += active.size * some.size
        alike = cluster["label"][active][:, None] == piece["label"][some][None, :]
        fits = alike & (cluster["row"][active][:, None] != piece["row"][some][None, :]) if cluster["same"] else ~alike
        fresh = [found]
        for w in range(windows):
            u, v = np.nonzero(fits & (scores >= least[active, w][:, None]) & (scores <= cluster["high"][active, w][:, None]))
            fresh.append([active[u], np.full(u.size, w), piece["row"][some[v]], piece["id"][some[v]], scores[u, v].astype(np.int64)])
        found = [np.concatenate(column) for column in zip(*fresh, strict=True)]
        group = found[0] * windows + found[1]
        ranked = np.lexsort((found[2], found[3], -found[4], group))
        found, group = [column[ranked] for column in found], group[ranked]
        place = np.arange(group.size) - np.searchsorted(group, group)
        found, group, place = [column[place < keep] for column in found], group[place < keep], place[place < keep]
        full = np.flatnonzero(place == keep - 1)
        least[found[0][full], found[1][full]] = np.maximum(least[found[0][full], found[1][full]], found[4][full])
    return found, scored


def _walk(pairs: DataFrame, wants: DataFrame, slices: DataFrame, centres: Centres, same: bool, keep: int) -> DataFrame:
    """``anchor, window, row, id, score``: the best of every wanted window within each slice that ``pairs`` (cluster, slice) names.

    ``wants`` are anchors with ``low`` and ``high``, arrays with one place a window.
    """

    def run(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        found = [np.empty(0, np.int64)] * 5
        if ours.num_rows and theirs.num_rows:
            ours = ours.combine_chunks()
            held = theirs.to_pylist()[0]
            width, home = held["their_width"], ours.column("home")[0].as_py()
            row, names, label = np.frombuffer(held["numbers"], np.int64).reshape(3, -1)
            whole = np.frombuffer(held["slice_terms"], held["kind"]).reshape(-1, width)
            terms = _matrix(ours.column("terms").combine_chunks(), width)
            norms = np.linalg.norm(whole.astype(np.float64), axis=1)
            size = ours.column("norm").to_numpy()
            kind = np.float64 if (norms.max() * size.max()) * (1 + 1e-6) < EXACT else np.int64
            angle = _angles(whole.astype(np.float64), centres[width][[home]])[:, 0] if home >= 0 else np.zeros(len(whole))
            low, high = (np.array(ours.column(c).to_pylist(), np.int64).reshape(len(terms), -1) for c in ("low", "high"))
            cluster = {"terms": terms.astype(kind), "norm": size, "row": ours.column("row").to_numpy(), "label": ours.column("label").to_numpy()}
            cluster |= {"low": low, "high": high, "same": same, "angle": float(ours.column("angle").to_numpy().max()) + SLACK}
            piece = {"terms": whole.astype(kind), "norm": norms, "row": row, "id": names, "label": label, "angle": angle}
            found, _ = best_first(cluster, piece, keep)
            found[0] = cluster["row"][found[0]]
        return pa.table(dict(zip(("anchor", "window", "row", "id", "score"), map(pa.array, found), strict=True)))

    keys = ["width", "other", "chunk", "slice"]
    left = wants.withColumn("other", F.col("home")).join(pairs, ["width", "other", "chunk"])
    left = left.select(*keys, "home", "row", "label", "terms", "norm", "angle", "low", "high")
    packed = slices.select("slice", "kind", "numbers", F.col("terms").alias("slice_terms"))
    theirs = [f"their_{k}" for k in keys]
    right = pairs.join(packed, "slice").select(*[F.col(k).alias(t) for k, t in zip(keys, theirs, strict=True)], "kind", "numbers", "slice_terms")
    return left.groupBy(*keys).cogroup(right.groupBy(*theirs)).applyInArrow(run, "anchor bigint, window bigint, row bigint, id bigint, score bigint")


def _ranked(found: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def _needed(wants: DataFrame, between: DataFrame) -> DataFrame:
    """``width, other, chunk, slice, bound``: the slices that a piece of a cluster has to walk."""
    least = F.array_min("low")
    need = F.when(F.col("norm") > 0, least / F.col("norm")).when(least <= 0, F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    clusters = wants.groupBy("width", F.col("home").alias("other"), "chunk").agg(F.max("angle").alias("wide"), F.min(need).alias("need"))
    bound = F.col("reach") * F.greatest(F.lit(0.0), F.cos(F.greatest(F.lit(0.0), F.col("apart") - F.col("spread") - F.col("wide") - SLACK)))
    met = between.join(clusters, ["width", "other"]).withColumn("bound", bound)
    return met.filter(F.col("bound") + F.abs("bound") * SLACK + SLACK >= F.col("need")).select("width", "other", "chunk", "slice", "bound")


def hard_negatives(
    rows: DataFrame, asked: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, share: tuple[int, int] = (80, 100)
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` are ``id, label, terms`` of whole numbers; the rows where ``asked`` holds
    are anchors. Of the other rows with its label an anchor takes the ``positives``
    highest scores (all, if fewer); for each it takes the ``negatives`` highest scores
    among rows of other labels from ``share`` of the positive's score up to that score.
    Ties go to the smaller id. Positives with a negative score have no negatives.
    Every repeated row is an anchor, a positive and a negative of its own; vectors of
    another length than the anchor's take no part for it. A vector whose squared
    length reaches 2^60 is an error, since scores would not fit 64 bits. An empty
    table gives an empty one; other columns are not carried.
    """
    ready(rows.sparkSession)
    marked = rows.select("id", "label", "terms", F.coalesce(asked, F.lit(False)).alias("asked"))
    sample = marked.filter("asked").orderBy(F.xxhash64("id", "terms"), "id").limit(SAMPLE).select("terms").toArrow().column("terms").combine_chunks()
    widths = np.diff(sample.offsets.to_numpy()) if len(sample) else np.empty(0, np.int64)
    centres = {int(w): fit_centres(_matrix(sample.filter(pa.array(widths == w)), w).astype(np.float64)) for w in np.unique(widths)}
    placed = cut_lineage(_placed(marked, centres), "placed")
    slices = cut_lineage(_slices(placed), "slices")
    between = cut_lineage(_between(slices, centres), "between")
    anchors = placed.filter("asked")
    sizes = anchors.groupBy("width", "home").agg(F.ceil(F.count("*") / CHUNK_ROWS).alias("chunks"))
    anchors = anchors.join(sizes, ["width", "home"]).withColumn("chunk", F.pmod(F.xxhash64("row"), "chunks"))
    anchors = cut_lineage(anchors.select("row", "id", "label", "terms", "width", "home", "angle", "norm", "chunk"), "anchors")

    always, never = F.lit(-NEVER).cast("bigint"), F.lit(NEVER).cast("bigint")
    everything = anchors.withColumns({"low": F.array(always), "high": F.array(never)})
    keys = ["width", "other", "chunk"]
    first = _needed(everything, between).groupBy(*keys).agg(F.max_by("slice", F.struct("bound", "slice")).alias("slice"))
    first = cut_lineage(first, "first")
    seen = cut_lineage(_walk(first, everything, slices, centres, True, positives), "seen")
    kth = seen.groupBy(F.col("anchor").alias("row")).agg(F.count("*").alias("n"), F.min("score").alias("kth")).filter(F.col("n") >= positives)
    wanted = anchors.join(kth, "row", "left").withColumns({"low": F.array(F.coalesce("kth", always)), "high": F.array(never)}).drop("n", "kth")
    wanted = cut_lineage(wanted, "wanted")
    rest = cut_lineage(_needed(wanted, between).drop("bound").join(first, [*keys, "slice"], "left_anti"), "rest")
    best = _ranked(seen.unionByName(_walk(rest, wanted, slices, centres, True, positives)), positives)
    best = cut_lineage(best.filter("score >= 0").select("anchor", (F.col("rank") - 1).alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    part, total = share
    spans = best.groupBy(F.col("anchor").alias("row")).agg(F.array_sort(F.collect_list(F.struct("window", "positive_score"))).alias("spans"))
    scores = F.transform(F.sequence(F.lit(0), F.lit(positives - 1)), lambda i: F.get("spans", i)["positive_score"])
    windows = anchors.join(spans, "row").withColumn("scores", scores)
    least = F.expr(f"transform(scores, s -> coalesce((cast(s as decimal(20, 0)) * {part} + {total - 1}) div {total}, {NEVER}L))")
    windows = windows.withColumns({"low": least, "high": F.transform("scores", lambda s: F.coalesce(s, always))}).drop("spans", "scores")
    windows = cut_lineage(windows, "windows")
    pairs = cut_lineage(_needed(windows, between).drop("bound"), "pairs")
    ranked = _ranked(_walk(pairs, windows, slices, centres, False, negatives), negatives)
    named = ranked.join(best, ["anchor", "window"]).join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    return named.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))

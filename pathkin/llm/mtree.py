"""Exact top-k inner products by best-first search of M-trees.

Vectors get one more component that brings all of them to the largest norm, so
that the nearest vectors of a query by distance are those of the largest inner
product. A bounded sample of vectors serves as pivots; every vector belongs to
its nearest pivot, and a pivot's vectors are dealt to pages of bounded size. A
page is an M-tree of its own: nodes with a centre, a covering radius and the
distance from the parent's centre, and entries with their distance from their
node's centre.

A query first searches the page of its nearest pivot. Its k-th score there is the
bound with which it then visits only pages that can hold a better vector. In a
page it takes nodes in the order of their least possible distance, and stored
distances rule out nodes and entries without computing theirs.
"""

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pathkin.session import cut_lineage

K = 5
SCALE = 256
#: Vectors sampled as pivots, vectors of a page, entries of a node, and queries searched together.
PIVOTS = 64
PAGE = 4096
NODE = 64
QUERIES = 1024
#: Distances are compared with this relative slack, as they are rounded.
SLACK = 1e-7


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    """``x`` with the component that gives every row the squared norm ``top``."""
    rest = np.sqrt(np.maximum(top - (x * x).sum(axis=1), 0.0))
    return np.concatenate([x, rest[:, None]], axis=1)


class Page:
    """An M-tree of two levels over the vectors of one page."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, top: float):
        up = lifted(x, top)
        self.centre = up.mean(axis=0)
        n = max(1, -(-len(ids) // NODE))
        # Routing objects are vectors far from each other; each vector joins the nearest with room.
        far = ((up - self.centre) ** 2).sum(axis=1)
        chosen = []
        for _ in range(n):
            k = int(far.argmax())
            chosen.append(k)
            far = np.minimum(far, ((up - up[k]) ** 2).sum(axis=1))
        self.routes = up[chosen]
        d = np.sqrt(np.maximum(((up**2).sum(1)[:, None] + (self.routes**2).sum(1)[None, :]) - 2 * up @ self.routes.T, 0))
        node = d.argmin(axis=1)
        order = np.lexsort((ids, node))
        self.ids, self.x, node = ids[order], x[order], node[order]
        self.to_route = np.sqrt(((up[order] - self.routes[node]) ** 2).sum(axis=1))
        self.cuts = np.searchsorted(node, np.arange(n + 1))
        self.radius = np.array([self.to_route[a:b].max(initial=0.0) for a, b in zip(self.cuts[:-1], self.cuts[1:])])
        self.to_centre = np.sqrt(((self.routes - self.centre) ** 2).sum(axis=1))
        self.top = top
        self.computed = 0

    def search(self, query_id: int, q: np.ndarray, k: int, bound: float) -> list[tuple[float, int]]:
        """(score, -id) of the best ``k`` vectors but the query's own, of those that reach ``bound``."""
        up = np.append(q, 0.0)
        norm = float(q @ q)
        best: list[tuple[float, int]] = []

        def reach() -> float:
            """Distance beyond which no vector is good enough."""
            least = max(bound, best[0][0]) if len(best) == k else bound
            d = np.sqrt(max(norm + self.top - 2 * least, 0.0)) if least > -np.inf else np.inf
            return d + SLACK * (1 + np.sqrt(norm + self.top))

        to_centre = float(np.sqrt(((up - self.centre) ** 2).sum()))
        open_ = np.flatnonzero(np.abs(to_centre - self.to_centre) - self.radius <= reach())
        self.computed += len(open_) + 1
        d = np.sqrt(((self.routes[open_] - up) ** 2).sum(axis=1))
        heap = [(max(0.0, a - r), j, a) for a, r, j in zip(d.tolist(), self.radius[open_].tolist(), open_.tolist())]
        heapq.heapify(heap)
        while heap:
            least, j, away = heapq.heappop(heap)
            limit = reach()
            if least > limit:
                break
            a, b = self.cuts[j], self.cuts[j + 1]
            rows = np.flatnonzero(np.abs(away - self.to_route[a:b]) <= limit) + a
            self.computed += len(rows)
            scores = self.x[rows] @ q
            good = scores >= max(bound, best[0][0] if len(best) == k else -np.inf)
            for s, i in zip(scores[good].tolist(), self.ids[rows[good]].tolist()):
                if i == query_id:
                    continue
                if len(best) < k:
                    heapq.heappush(best, (s, -i))
                elif (s, -i) > best[0]:
                    heapq.heapreplace(best, (s, -i))
        return best


def _vectors(column) -> np.ndarray:
    return np.array([np.frombuffer(v, np.float64) for v in column])


def _whole(width: int | None):
    """Whole-number vectors: (vec_id, x, norm) of vectors without null or non-finite components."""

    def run(batches):
        for batch in batches:
            ids, out, norms, widths = [], [], [], []
            for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist()):
                if i is None or not v or any(c is None for c in v) or width not in (None, len(v)):
                    continue
                x = np.floor(SCALE * np.array(v, np.float64))
                if np.isfinite(x).all():
                    ids.append(i)
                    out.append(x.tobytes())
                    norms.append(float(x @ x))
                    widths.append(len(x))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(out, pa.binary()), pa.array(norms, pa.float64()), pa.array(widths, pa.int32())],
                ["vec_id", "x", "norm", "width"],
            )

    return run


def _assign(pivots: np.ndarray, top: float):
    up = lifted(pivots, top)
    squares = (up**2).sum(1)[None, :]

    def run(batches):
        for rows in batches:
            if len(rows):
                x = lifted(_vectors(rows["x"]), top)
                d = np.maximum((x**2).sum(1)[:, None] + squares - 2 * x @ up.T, 0)
                pivot = d.argmin(axis=1)
                away = np.sqrt(((x - up[pivot]) ** 2).sum(axis=1))
                yield rows[["vec_id", "x"]].assign(pivot=pivot.astype("int32"), away=away)

    return run


def _route(pivots: np.ndarray, radii: np.ndarray, top: float, seeds: bool):
    """The nearest pivot of each query with vectors, or the others it must visit."""
    up = lifted(pivots, top)

    def run(batches):
        for rows in batches:
            if not len(rows):
                continue
            q = _vectors(rows["x"])
            norm = (q * q).sum(axis=1)
            d = np.sqrt(np.maximum(norm[:, None] + top - 2 * q @ pivots.T, 0))
            nearest = np.where(radii >= 0, d, np.inf).argmin(axis=1)
            if seeds:
                yield rows[["vec_id", "x"]].assign(pivot=nearest.astype("int32"), bound=-np.inf)
                continue
            bound = rows["bound"].fillna(-np.inf).to_numpy()
            with np.errstate(invalid="ignore"):
                reach = np.sqrt(np.maximum(norm + top - 2 * bound, 0)) + SLACK * (1 + np.sqrt(norm + top))
            visit = (radii >= 0)[None, :] & (d - radii[None, :] <= reach[:, None])
            visit[np.arange(len(q)), nearest] = False
            i, j = np.nonzero(visit)
            yield pd.DataFrame({"vec_id": rows["vec_id"].to_numpy()[i], "x": rows["x"].to_numpy()[i], "pivot": j.astype("int32"), "bound": bound[i]})

    return run


def _search(top: float, k: int):
    def run(page: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(page) and len(queries):
            tree = Page(page["vec_id"].to_numpy(), _vectors(page["x"]), top)
            for i, q, bound in zip(queries["vec_id"].tolist(), _vectors(queries["x"]), queries["bound"].tolist()):
                out += [(i, -other, int(score)) for score, other in tree.search(i, q, k, bound)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query; partial results are cut before they meet."""
    order = F.struct((-F.col("score")).alias("s"), "vec_id")
    ranked = found.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(order)), 1, k).alias("best"))
    return ranked.select("query_id", F.posexplode("best").alias("rank", "b")).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.s")).alias("score")
    )


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of ``vectors`` (vec_id, embedding) of
    the largest inner product with each row of ``queries`` (the same columns).

    Components become floor(256 * x). Rows of the query's own vec_id are left
    out; ties go to the smaller vec_id. Rows without a vec_id, null or empty
    vectors and those holding null or non-finite components take no part, nor do
    vectors of another length than most (of two as common, the shorter). Repeated rows count each.
    Fewer vectors than ``k`` give fewer rows; an empty table gives none. Other
    columns are left out.
    """
    spark, schema = vectors.sparkSession, "vec_id bigint, x binary, norm double, width int"
    fields = [F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>")]
    known = cut_lineage(vectors.select(*fields).mapInArrow(_whole(None), schema))
    most = known.groupBy("width").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("top"))
    first = most.orderBy(F.desc("n"), "width").first()
    if first is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    width, top = first["width"], float(first["top"])
    known = known.filter(F.col("width") == width)
    asked = cut_lineage(queries.select(*fields).mapInArrow(_whole(width), schema).select("vec_id", "x"))
    sample = known.orderBy(F.xxhash64("vec_id"), "vec_id", "x").limit(PIVOTS).select("x").collect()
    pivots = np.unique(np.array([np.frombuffer(r["x"], np.float64) for r in sample]), axis=0)
    placed = cut_lineage(
        known.select("vec_id", "x").mapInPandas(_assign(pivots, top), "vec_id bigint, x binary, pivot int, away double")
    )
    counts = placed.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius")).collect()
    radii, pages = np.full(len(pivots), -1.0), np.ones(len(pivots), np.int64)
    for r in counts:  # one row per pivot
        radii[r["pivot"]], pages[r["pivot"]] = r["radius"], -(-r["n"] // PAGE)
    pages_of = F.get(F.array(*map(F.lit, pages.tolist())), F.col("pivot"))
    parts = max(1, -(-asked.count() // QUERIES))
    cells = placed.select("vec_id", "x", "pivot", F.pmod(F.xxhash64("vec_id"), pages_of).cast("int").alias("page"))
    cells = cells.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def visit(rows: DataFrame, seeds: bool) -> DataFrame:
        routed = rows.mapInPandas(_route(pivots, radii, top, seeds), "vec_id bigint, x binary, pivot int, bound double")
        routed = routed.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int"))
        routed = routed.withColumn("page", F.explode(F.sequence(F.lit(0), (pages_of - 1).cast("int"))))
        keys = ["pivot", "page", "part"]
        found = routed.groupBy(*keys).cogroup(cells.groupBy(*keys))
        search = _search(top, k)
        return found.applyInPandas(lambda q, p: search(p, q), "query_id bigint, vec_id bigint, score bigint")

    near = cut_lineage(visit(asked, True))
    bounds = _best(near, k).filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("bound"))
    rest = visit(asked.join(bounds, "vec_id", "left"), False)
    return _best(near.unionByName(rest), k)

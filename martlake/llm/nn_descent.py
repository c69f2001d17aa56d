"""Nearest neighbours by largest inner product: a neighbour graph from NN-descent,
searched greedily.

*Nodes.*  Equal vectors are one node; it keeps the ``MEMBERS`` smallest ids, more
than which no answer can need.  A node's code is its vector divided by the largest
norm of the table, with one more component that makes all codes unit vectors (so
that the largest inner product is the smallest angle), in 8 bits a component.
Codes choose candidates only; scores come from the original vectors.

*First graph.*  Every node is put into the blocks of its ``PLACES`` nearest pivots.
Pivots are a sample of nodes, one per ``BLOCK / PLACES`` nodes and at most ``PIVOTS``;
a block beyond ``TILE`` nodes is dealt into tiles by hash.  Nodes of one tile are
compared with each other; each node is also in one tile of nodes from anywhere, which
links the blocks.

*NN-descent.*  Two neighbours of a common node are compared if one of them is new to
that node's list, and enter each other's lists of ``DEGREE`` where they are nearer
than the farthest one there.  Rounds go on until under ``SETTLED`` of all entries are
new.  A round is two joins: nodes lie in chunks (their nearest pivot's block or a tile
of it), the codes of all neighbours of a chunk are joined to it once, compared there,
and what was found is joined to the lists by node.

*Search.*  A query starts at its own node and expands the nearest candidates not yet
expanded until the best ``BEAM`` ones all are; the same two joins a round.  The best
ones are then scored in double precision.

Every list, tile and chunk is bounded by a parameter, whatever the data; hot blocks
are split.  Lists are bounded by the method (a graph of fixed degree), so that the
result is approximate: the tests measure recall.

Defined cases: rows whose id or vector is null, whose vector is zero, has a null or
non-finite component, or not the table's most frequent length (ties: the longer) take
no part.  Repeated rows count once; one id with several vectors is several
candidates and several queries, none of them a candidate of a query of that id.  Ties
go to the smaller id.  Fewer candidates than asked for are all returned; other columns,
whatever their names, are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlake.llm.spectrum_slicing import usual_length
from martlake.llm.tables import dropped, stored

NEIGHBOURS, MEMBERS = 20, 21
DEGREE, BEAM = 32, 64
PLACES, BLOCK, TILE, PIVOTS = 6, 4096, 8192, 4096
#: Entries that a node takes from one tile.
FROM_TILE = 16
SETTLED, ROUNDS = 0.02, 12
#: Products of codes held at a time.
CELLS = 1 << 23

_GRAPH = (
    "node long, chunk long, code binary, scale float, ids array<long>, sims array<float>, fresh array<byte>, n_fresh int"
)


def nodes_of(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, vector) of the rows that take part, each once."""
    v = F.col(vector_column)
    good = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(v, lambda c: c != 0)
    rows = table.filter(F.col(id_column).isNotNull() & v.isNotNull() & good)
    # 0.0 for -0.0: they are equal
    plain = F.transform(v, lambda c: F.when(c == 0, F.lit(0).cast("double")).otherwise(c.cast("double")))
    kind = table.schema[vector_column].dataType.simpleString()
    return rows.select(F.col(id_column).cast("long").alias("id"), plain.cast(kind).alias("vector"))


def _floats(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def _codes(column: pa.Array) -> np.ndarray:
    """Rows of 8-bit components from equally long binaries."""
    if not len(column):
        return np.zeros((0, 1), np.int8)
    return np.frombuffer(b"".join(column.to_pylist()), np.int8).reshape(len(column), -1)


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind))


def _unit(x: np.ndarray, norm: float) -> np.ndarray:
    """Vectors over the largest norm, made unit by one more component."""
    y = x / norm
    rest = np.sqrt(np.maximum(0.0, 1 - (y * y).sum(1)))
    return np.column_stack([y, rest])


def _encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    top = np.abs(x).max(1)
    return np.rint(x * (127 / top)[:, None]).astype(np.int8), (top / 127).astype(np.float32)


def _best(owner, ids, sims, fresh, most: int):
    """Of each owner's entries (each id once, an old entry before a new one) the
    ``most`` nearest, ties to the smaller id; owners ascending."""
    order = np.lexsort((fresh, ids, owner))
    owner, ids, sims, fresh = owner[order], ids[order], sims[order], fresh[order]
    first = np.ones(len(owner), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (ids[1:] != ids[:-1])
    owner, ids, sims, fresh = owner[first], ids[first], sims[first], fresh[first]
    order = np.lexsort((ids, -sims, owner))
    owner, ids, sims, fresh = owner[order], ids[order], sims[order], fresh[order]
    opens = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else np.zeros(0, int)
    sizes = np.diff(np.append(opens, len(owner)))
    keep = np.arange(len(owner)) - np.repeat(opens, sizes) < most
    return owner[keep], ids[keep], sims[keep], fresh[keep]


def coded(groups: DataFrame, d: int, norm: float, pivots: np.ndarray) -> DataFrame:
    """(node, code, scale, blocks, nearest first)."""
    places = min(PLACES, len(pivots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                x = _unit(_floats(part.column("vector"), d), norm)
                code, scale = _encode(x)
                near = x @ pivots.T
                blocks = np.argsort(-near, axis=1, kind="stable")[:, :places]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("node"), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(scale),
                        _lists(blocks.ravel(), np.full(len(x), places), pa.int32()),
                    ],
                    ["node", "code", "scale", "blocks"],
                )

    return groups.select("node", "vector").mapInArrow(run, "node long, code binary, scale float, blocks array<int>")


def tile_graph(placed: DataFrame) -> DataFrame:
    """(node, ids, sims): the nearest nodes of every node in each of its tiles."""

    def run(table: pa.Table) -> pa.Table:
        part = table.combine_chunks()
        node = part.column("node").to_numpy()
        x = _codes(part.column("code")).astype(np.float32) * part.column("scale").to_numpy()[:, None]
        most = min(FROM_TILE, len(node) - 1)
        if most < 1:
            return pa.table({"node": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int64())),
                             "sims": pa.array([], pa.list_(pa.float32()))})
        ids, sims = [], []
        step = max(1, CELLS // len(node))
        for first in range(0, len(node), step):
            near = x[first : first + step] @ x.T
            own = np.arange(len(near))
            near[own, first + own] = -np.inf
            at = np.argpartition(-near, most - 1, axis=1)[:, :most]
            ids.append(node[at].ravel())
            sims.append(near[own[:, None], at].ravel())
        sizes = np.full(len(node), most)
        return pa.table({"node": part.column("node"), "ids": _lists(np.concatenate(ids), sizes, pa.int64()),
                         "sims": _lists(np.concatenate(sims), sizes, pa.float32())})

    return placed.groupBy("block", "tile").applyInArrow(run, "node long, ids array<long>, sims array<float>")


def merged(found: DataFrame, most: int) -> DataFrame:
    """The lists of every node made one of at most ``most`` entries; rows that
    carry a code say which nodes there are."""

    def reduce(batch: pa.RecordBatch) -> tuple:
        sizes = batch.column("ids").value_lengths().fill_null(0).to_numpy()
        return (
            np.repeat(batch.column("node").to_numpy(), sizes), batch.column("ids").flatten().to_numpy(),
            batch.column("sims").flatten().to_numpy(), batch.column("fresh").flatten().to_numpy(),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = tuple(np.zeros(0, k) for k in (np.int64, np.int64, np.float32, np.int8))
        waiting: list[tuple] = []  # node, chunk, code, scale of nodes not yet given out

        def out(nodes: list[tuple], entries: tuple) -> pa.RecordBatch:
            names = np.array([n[0] for n in nodes], np.int64)
            owner, ids, sims, fresh = entries
            low, high = np.searchsorted(owner, names, "left"), np.searchsorted(owner, names, "right")
            sizes = high - low
            # entries of nodes without a row do not occur
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(names), pa.array([n[1] for n in nodes], pa.int64()), pa.array([n[2] for n in nodes], pa.binary()),
                    pa.array([n[3] for n in nodes], pa.float32()), _lists(ids, sizes, pa.int64()),
                    _lists(sims, sizes, pa.float32()), _lists(fresh, sizes, pa.int8()),
                    pa.array(np.bincount(np.searchsorted(names, owner), fresh, len(names)).astype(np.int32)),
                ],
                ["node", "chunk", "code", "scale", "ids", "sims", "fresh", "n_fresh"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            held = _best(*(np.concatenate(p) for p in zip(held, reduce(batch))), most)
            named = batch.filter(batch.column("code").is_valid())
            waiting += zip(*(named.column(c).to_pylist() for c in ("node", "chunk", "code", "scale")))
            last = batch.column("node")[batch.num_rows - 1].as_py()  # it may go on in the next batch
            done = [n for n in waiting if n[0] != last]
            if done:
                waiting = [n for n in waiting if n[0] == last]
                cut = int(np.searchsorted(held[0], last))
                yield out(done, tuple(h[:cut] for h in held))
                held = tuple(h[cut:] for h in held)
        if waiting:
            yield out(waiting, held)

    return found.repartition("node").sortWithinPartitions("node").mapInArrow(run, _GRAPH)


def _nothing(*names: str) -> list[Column]:
    kinds = {"chunk": "long", "code": "binary", "scale": "float"}
    return [F.lit(None).cast(kinds[n]).alias(n) for n in names]


def _found(found: DataFrame) -> DataFrame:
    """Found entries as rows of :func:`merged`."""
    return found.select(
        "node", *_nothing("chunk", "code", "scale"), "ids", "sims",
        F.transform("ids", lambda _: F.lit(1).cast("byte")).alias("fresh"),
    )


def _in_graph(graph: DataFrame) -> DataFrame:
    return graph.select(
        "node", "chunk", "code", "scale", "ids", "sims", F.transform("ids", lambda _: F.lit(0).cast("byte")).alias("fresh")
    )


def common_neighbours(graph: DataFrame, most: int) -> DataFrame:
    """(node, ids, sims): pairs of neighbours of common nodes that come nearer
    than the farthest entry of the node's list."""
    lists = graph.filter("n_fresh > 0").select("chunk", "ids", "fresh")
    full = F.size("sims") >= most
    side = graph.select(
        "node", "code", "scale",
        F.when(full, F.element_at("sims", -1)).otherwise(F.lit(float("-inf"))).cast("float").alias("least"),
    )
    used = lists.select("chunk", F.explode("ids").alias("node")).distinct()
    codes = used.join(side, "node").select(F.col("chunk").alias("part"), "node", "code", "scale", "least")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.combine_chunks(), right.combine_chunks()
        order = np.argsort(right.column("node").to_numpy())
        node = right.column("node").to_numpy()[order]
        x = (_codes(right.column("code")).astype(np.float32) * right.column("scale").to_numpy()[:, None])[order]
        least = right.column("least").to_numpy()[order]
        sizes = left.column("ids").chunk(0).value_lengths().to_numpy() if left.num_rows else np.zeros(0, int)
        # lists of equal length as one matrix, shorter ones filled with -1
        width = int(sizes.max(initial=0))
        at = np.full((len(sizes), width), -1)
        new = np.zeros((len(sizes), width), bool)
        inside = np.arange(width) < sizes[:, None]
        at[inside] = np.searchsorted(node, left.column("ids").chunk(0).flatten().to_numpy())
        new[inside] = left.column("fresh").chunk(0).flatten().to_numpy() > 0
        kept = tuple(np.zeros(0, k) for k in (np.int64, np.int64, np.float32, np.int8))
        step = max(1, CELLS // (4 * max(1, width * max(width, x.shape[1]))))
        parts = [kept]
        held = 0
        for first in range(0, len(at), step):
            a, n = at[first : first + step], new[first : first + step]
            y = x[a]
            sim = y @ y.transpose(0, 2, 1)
            ok = (n[:, :, None] | n[:, None, :]) & (a[:, :, None] >= 0) & (a[:, None, :] >= 0)
            ok &= sim > least[a][:, :, None]
            ok[:, np.arange(width), np.arange(width)] = False
            g, i, j = np.nonzero(ok)
            parts.append((a[g, i], a[g, j], sim[g, i, j], np.ones(len(g), np.int8)))
            held += len(g)
            if held > CELLS // 4:
                parts = [_best(*(np.concatenate(p) for p in zip(*parts)), most)]
                held = len(parts[0][0])
        owner, ids, sims, _ = _best(*(np.concatenate(p) for p in zip(*parts)), most)
        names, counts = np.unique(owner, return_counts=True)
        return pa.table({
            "node": pa.array(node[names], pa.int64()), "ids": _lists(node[ids], counts, pa.int64()),
            "sims": _lists(sims, counts, pa.float32()),
        })

    return lists.groupBy("chunk").cogroup(codes.groupBy("part")).applyInArrow(
        run, "node long, ids array<long>, sims array<float>"
    )


class Graph:
    """The written tables of an index: ``groups`` (node, ids, vector) and
    ``lists`` (as ``_GRAPH``), with their folders."""

    def __init__(self, rows: DataFrame, d: int, degree: int = DEGREE):
        self.spark, self.d, self.degree = rows.sparkSession, d, degree
        first = Window.partitionBy("vector").orderBy("id")
        ranked = rows.distinct().withColumn("place", F.row_number().over(first)).filter(F.col("place") <= MEMBERS)
        groups = ranked.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
        self.groups, folder = stored(groups.withColumn("node", F.monotonically_increasing_id()), "ann-nodes")
        self.folders = [folder]
        squares = F.aggregate("vector", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
        self.n, norm = self.groups.agg(F.count(F.lit(1)), F.max(F.sqrt(squares))).first()
        self.norm = norm or 1.0
        self.rounds: list[int] = []
        if self.n:
            self._build()

    def _build(self) -> None:
        wanted = max(1, min(PIVOTS, self.n * PLACES // BLOCK))
        # at most PIVOTS vectors
        sample = self.groups.orderBy(F.xxhash64("node"), "node").limit(wanted).select("vector").collect()
        pivots = _unit(np.array([r["vector"] for r in sample], float), self.norm)
        nodes, nodes_folder = stored(coded(self.groups, self.d, self.norm, pivots), "ann-codes")
        placed = nodes.select("node", "code", "scale", F.posexplode("blocks").alias("place", "block"))
        counts = placed.groupBy("block").count().select(
            "block", F.greatest(F.lit(1), F.ceil(F.col("count") / TILE)).cast("int").alias("tiles")
        )
        # at most PIVOTS rows
        placed = placed.join(F.broadcast(counts), "block").withColumn("tile", F.expr("pmod(xxhash64(node), tiles)"))
        # one more tile of nodes from anywhere links the blocks
        anywhere = F.expr(f"pmod(xxhash64(node, 1), {-(-self.n // TILE)})")
        mixed = nodes.select(F.lit(-1).alias("block"), anywhere.alias("tile"), "node", "code", "scale")
        found = tile_graph(placed.select("block", "tile", "node", "code", "scale").union(mixed))
        own = placed.filter("place = 0").select(
            "node", (F.col("block") * F.lit(1 << 32) + F.col("tile")).alias("chunk"), "code", "scale",
            F.array().cast("array<long>").alias("ids"), F.array().cast("array<float>").alias("sims"),
            F.array().cast("array<byte>").alias("fresh"),
        )
        self.lists, folder = stored(merged(_found(found).unionByName(own), self.degree), "ann-graph")
        dropped(self.spark, nodes_folder)
        for _ in range(ROUNDS):
            fresh = self.lists.agg(F.sum("n_fresh")).first()[0] or 0
            self.rounds.append(fresh)
            if fresh <= (SETTLED if len(self.rounds) > 1 else 0) * self.n * self.degree:
                break
            found = common_neighbours(self.lists, self.degree)
            now = merged(_in_graph(self.lists).unionByName(_found(found)), self.degree)
            before, (self.lists, folder) = folder, stored(now, "ann-graph")
            dropped(self.spark, before)
        self.folders.append(folder)

    def search(self, queries: DataFrame, beam: int = BEAM) -> DataFrame:
        """(node, id, score), the ``MEMBERS`` best ids of every query node
        (column ``node``, each once)."""
        start = self.groups.join(queries, "node").join(self.lists.select("node", "chunk"), "node")
        state, folder = stored(self._opened(start), "ann-state")
        while state.filter("open > 0").limit(1).count():
            before, (state, folder) = folder, stored(self._expanded(state, beam), "ann-state")
            dropped(self.spark, before)
        hits = state.select("node", F.explode("ids").alias("hit"))
        result, out = stored(self._scored(hits), "ann-scores")
        dropped(self.spark, folder)
        self.folders.append(out)
        return result

    def _opened(self, start: DataFrame) -> DataFrame:
        """Search states: every query at its own node, which is not expanded yet."""
        d, norm = self.d, self.norm

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _floats(batch.column("vector"), d) / norm
                code, scale = _encode(np.column_stack([x, np.zeros(len(x))]))
                one = np.ones(len(x), np.int32)
                sims = (x * x).sum(1).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("node"), batch.column("chunk"), pa.array([c.tobytes() for c in code], pa.binary()),
                        pa.array(scale), _lists(batch.column("node").to_numpy(), one, pa.int64()),
                        _lists(sims, one, pa.float32()), _lists(one, one, pa.int8()), pa.array(one),
                    ],
                    ["node", "chunk", "code", "scale", "ids", "sims", "todo", "open"],
                )

        return start.select("node", "chunk", "vector").mapInArrow(run, _STATE)

    def _expanded(self, state: DataFrame, beam: int) -> DataFrame:
        """One step: the open candidates of every query are expanded."""
        going = state.filter("open > 0")
        pairs = going.select("chunk", F.explode(F.arrays_zip("ids", "todo")).alias("c")).filter("c.todo = 1")
        frontier = pairs.select("chunk", F.col("c.ids").alias("node")).distinct()
        steps = frontier.join(self.lists.select("node", F.col("ids").alias("next")), "node")
        codes = (
            steps.select("chunk", F.explode("next").alias("node")).distinct()
            .join(self.lists.select("node", "code", "scale"), "node")
        )
        part = F.col("chunk").alias("part")
        side = steps.select(part, "node", "next", *_nothing("code", "scale")).unionByName(
            codes.select(part, "node", F.lit(None).cast("array<long>").alias("next"), "code", "scale")
        )

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            left, right = left.combine_chunks(), right.combine_chunks()
            has = right.column("code").is_valid()
            table, lists = right.filter(has), right.filter(pa.compute.invert(has))
            order = np.argsort(table.column("node").to_numpy())
            node = table.column("node").to_numpy()[order]
            x = (_codes(table.column("code")).astype(np.float32) * table.column("scale").to_numpy()[:, None])[order]
            order = np.argsort(lists.column("node").to_numpy())
            lists = lists.take(pa.array(order)).combine_chunks()
            from_node = lists.column("node").to_numpy()
            nexts = lists.column("next").chunk(0) if lists.num_rows else pa.array([], pa.list_(pa.int64()))
            sizes = nexts.value_lengths().to_numpy()
            first, flat = np.cumsum(sizes) - sizes, nexts.flatten().to_numpy()
            q = _codes(left.column("code")).astype(np.float32) * left.column("scale").to_numpy()[:, None]
            n = left.column("ids").chunk(0).value_lengths().to_numpy()
            ids, sims, todo = (left.column(c).chunk(0).flatten().to_numpy() for c in ("ids", "sims", "todo"))
            owner = np.repeat(np.arange(len(n)), n)
            parts = [(owner, ids, sims, np.zeros(len(ids), np.int8))]
            ahead = np.flatnonzero(todo > 0)
            at = np.searchsorted(from_node, ids[ahead])
            step = max(1, CELLS // 256)
            for k in range(0, len(ahead), step):  # candidates of some expanded nodes at a time
                a = at[k : k + step]
                who = np.repeat(owner[ahead[k : k + step]], sizes[a])
                starts = np.repeat(first[a] - (np.cumsum(sizes[a]) - sizes[a]), sizes[a])
                to = np.searchsorted(node, flat[starts + np.arange(len(who))])
                pair = np.unique(who.astype(np.int64) * len(node) + to)
                who, to = pair // max(1, len(node)), pair % max(1, len(node))
                near = np.concatenate(
                    [np.einsum("ij,ij->i", q[who[s : s + 65536]], x[to[s : s + 65536]]) for s in range(0, len(who), 65536)]
                    or [np.zeros(0, np.float32)]
                )
                parts.append((who, node[to], near, np.ones(len(who), np.int8)))
                parts = [_best(*(np.concatenate(p) for p in zip(*parts)), beam)]
            owner, ids, sims, fresh = parts[0] if len(parts) == 1 else _best(*(np.concatenate(p) for p in zip(*parts)), beam)
            n = np.bincount(owner, minlength=len(n))
            return pa.table({
                **{c: left.column(c) for c in ("node", "chunk", "code", "scale")},
                "ids": _lists(ids, n, pa.int64()), "sims": _lists(sims, n, pa.float32()),
                "todo": _lists(fresh, n, pa.int8()), "open": pa.array(np.bincount(owner, fresh, len(n)).astype(np.int32)),
            })

        moved = going.groupBy("chunk").cogroup(side.groupBy("part")).applyInArrow(run, _STATE)
        return moved.unionByName(state.filter("open = 0"))

    def _scored(self, hits: DataFrame) -> DataFrame:
        """Exact scores, and the ids of the nodes hit."""
        d = self.d
        mine = self.groups.select("node", F.col("vector").alias("own"))
        theirs = self.groups.select(F.col("node").alias("hit"), "vector", F.col("ids").alias("members"))
        pairs = hits.join(theirs, "hit").join(mine, "node").select("node", "own", "vector", "members")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                a, b = _floats(batch.column("own"), d), _floats(batch.column("vector"), d)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node"), batch.column("members"), pa.array(np.einsum("ij,ij->i", a, b))],
                    ["node", "members", "score"],
                )

        scores = pairs.mapInArrow(run, "node long, members array<long>, score double")
        each = scores.select("node", F.explode("members").alias("id"), "score")
        best = Window.partitionBy("node").orderBy(F.desc("score"), "id")
        # one more than asked for: a query's own id is taken out later
        return each.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= MEMBERS)

    def drop(self) -> None:
        dropped(self.spark, *self.folders)


_STATE = (
    "node long, chunk long, code binary, scale float, ids array<long>, sims array<float>, todo array<byte>, open int"
)


def nearest(
    table: DataFrame, is_query: str, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``NEIGHBOURS`` nearest rows of every
    row for which ``is_query`` (an SQL condition on ``id``) holds."""
    rows = nodes_of(table, id_column, vector_column)
    d = usual_length(rows, "vector")
    rows = rows.filter(F.size("vector") == d)
    graph = Graph(rows, d)
    queries = rows.filter(is_query).distinct().join(graph.groups.select("vector", "node"), "vector").select("id", "node")
    queries, folder = stored(queries, "ann-queries")
    if graph.n:
        hits = graph.search(queries.select("node").distinct())
    else:
        hits = table.sparkSession.createDataFrame([], "node long, id long, score double, place int")
    pairs = queries.withColumnRenamed("id", "query_id").join(hits, "node").filter("id <> query_id")
    best = Window.partitionBy("query_id", "node").orderBy(F.desc("score"), "id")
    out = pairs.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= NEIGHBOURS)
    result, _ = stored(out.select("query_id", "rank", F.col("id").alias("vec_id"), "score"), "ann-result")
    graph.drop()
    dropped(table.sparkSession, folder)
    return result

"""Near-duplicate vectors by navigable small-world graphs: one graph per shard,
every shard queried with every vector.

Method: distinct vectors are dealt into shards by a hash. A shard's graph has layers:
in the order of a hash, the first 1/16 of the nodes are also on layer 1, the first
1/256 on layer 2 and so on. Nodes are inserted in batches with the usual choice of
diverse neighbours. Searches run for many queries at once: a beam walks each layer,
and on the base layer every hit at the threshold is followed up until no neighbour of
a hit is a new one, so a group of near copies may be larger than any beam.

Recall is audited twice, and beams are widened (doubled) until both pass: when a shard
is built, by probes (members turned away to just above the threshold, whose origin must
be found), and in every block of queries, by comparing one of ``AUDIT_EVERY`` queries
with the whole shard; a block that fails with a beam of the whole shard is scanned, as
are rows with so many hits that comparing is cheaper. Found pairs are verified in double precision.

Exact copies are one node with a weight; links are counted and joined where they are
found: a task returns a count per vector and a spanning forest of verified links, never
the pairs. Work is one search per vector and shard, so it grows with n * (n / rows of a
shard) * log(rows of a shard); memory is that of one shard and one block of queries.

Defined results: a vector that is null, empty, zero, or holds a null or non-finite
component links with nothing; vectors of different length do not link. Rows that
repeat an id are vectors of their own, exact copies link. A null vec_id takes part; a
component is named by its smallest id that is not null (null, if it has none), and
``kept`` compares null-safely. An empty table gives an empty result. Labels and extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, functions as F

from pricelab.llm import common as C

THRESHOLD = 0.95
SHARD_ROWS = 65_536
MIN_SHARDS = 4              # shards and blocks of small tables, so that cores share the work
M, WIDTH, CAP = 16, 32, 48  # links of a new node; kept after a cut; before one
EF_BUILD, EF_QUERY = 64, 16
LAYER = 16                  # one node of so many is on the next layer, too
EXPAND = 4                  # nodes of a beam that are expanded at a time
BATCH = 256
PROBES, PROBE_RECALL = 128, 0.99
AUDIT_EVERY, AUDIT_RECALL = 32, 0.99
FOLLOW = 512                # hits of a row (or 1/32 of the shard) beyond which it is scanned
MARGIN = 1e-4               # of single precision at the threshold


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision, without overflow."""
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


class Graph:
    """Layers of links over unit vectors; ``adj[layer][node]`` lists neighbours, padded with n."""

    def __init__(self, vectors: np.ndarray, adj: list[np.ndarray] | None = None):
        n = self.n = len(vectors)
        self.exact = vectors
        self.x = np.concatenate([vectors, np.zeros((1, vectors.shape[1]))]).astype(np.float32)
        self.sizes = [n]
        while self.sizes[-1] > 2 * LAYER:
            self.sizes.append(-(-self.sizes[-1] // LAYER))
        self.adj = adj or [np.full((m + 1, CAP), n, np.int32) for m in self.sizes]
        if adj is None:
            self._build()

    # -- search

    def beam(self, layer: int, q: np.ndarray, entry: np.ndarray, ef: int, hits_above: float | None = None):
        """Best ``ef`` nodes of a layer for every row of ``q``: ``(ids, sims)``, best first, and
        with ``hits_above`` also ``(row, node)`` of every node at least so similar."""
        n, adj, x = self.n, self.adj[layer], self.x
        at_end = len(adj) - 1            # row of padding in this layer's lists
        ids = np.full((len(q), ef), n, np.int32)
        sims = np.full((len(q), ef), -2.0, np.float32)
        done = np.ones((len(q), ef), bool)
        seen = np.zeros((len(q), n + 1), bool)
        seen[:, n] = True
        hits: list = []

        def offer(row, node):
            """Takes unseen nodes into the beams of their rows (``row`` ascending)."""
            s = np.einsum("ij,ij->i", x[node], q[row])
            if hits_above is not None:
                near = s >= hits_above
                hits.append((row[near], node[near]))
            good = s > sims[row, -1]
            row, node, s = row[good], node[good], s[good]
            if not len(row):
                return
            own, first, count = np.unique(row, return_index=True, return_counts=True)
            slot = np.arange(len(row)) - np.repeat(first, count)
            r = np.repeat(np.arange(len(own)), count)
            more = count.max()
            all_s = np.concatenate([sims[own], np.full((len(own), more), -2.0, np.float32)], 1)
            all_i = np.concatenate([ids[own], np.full((len(own), more), n, np.int32)], 1)
            all_d = np.concatenate([done[own], np.ones((len(own), more), bool)], 1)
            all_s[r, ef + slot], all_i[r, ef + slot], all_d[r, ef + slot] = s, node, False
            best = np.argsort(-all_s, axis=1, kind="stable")[:, :ef]
            sims[own], ids[own], done[own] = (np.take_along_axis(a, best, 1) for a in (all_s, all_i, all_d))

        def unseen(row, nodes):
            """New ``(row, node)`` pairs among ``nodes`` (one list of distinct nodes per row)."""
            new = ~seen[row[:, None], nodes]
            r, k = np.nonzero(new)
            r, v = row[r], nodes[new]
            seen[r, v] = True
            return r, v

        row, node = unseen(np.arange(len(q)), entry)
        offer(row, node)
        active = np.arange(len(q))
        while len(active):
            open_ = np.cumsum(~done[active], 1)
            pick = ~done[active] & (open_ <= EXPAND)
            some = pick.any(1)
            active, pick = active[some], pick[some]
            if not len(active):
                break
            r, slot = np.nonzero(pick)
            nodes = ids[active[r], slot]
            done[active[r], slot] = True
            turn = np.arange(len(r)) - np.searchsorted(r, r)
            rows, found = [], []
            for t in range(EXPAND):      # lists of one row may share nodes: one list at a time
                here = turn == t
                a, b = unseen(active[r[here]], adj[np.minimum(nodes[here], at_end)])
                rows.append(a)
                found.append(b)
            row, node = np.concatenate(rows), np.concatenate(found)
            by = np.argsort(row, kind="stable")
            offer(row[by], node[by])
        if hits_above is None:
            return ids, sims
        # follow every hit: near copies of near copies that a full beam let go; a row with
        # very many of them is cheaper to compare with the whole shard
        row, node = (np.concatenate(z) for z in zip(*hits))
        all_r, all_v, many = [row], [node], np.zeros(len(q), np.int64)
        while len(row):
            many += np.bincount(row, minlength=len(q))
            few = many[row] <= max(FOLLOW, n // 32)
            row, node = row[few], node[few]
            if not len(row):
                break
            fresh_r, fresh_v = [], []
            for lo in range(0, len(row), 20_000):
                r = np.repeat(row[lo:lo + 20_000], adj.shape[1])
                v = adj[node[lo:lo + 20_000]].ravel()
                new = ~seen[r, v]
                pair = np.unique(r[new].astype(np.int64) * (n + 1) + v[new])
                r, v = pair // (n + 1), pair % (n + 1)
                seen[r, v] = True
                near = np.einsum("ij,ij->i", x[v], q[r]) >= hits_above
                fresh_r.append(r[near])
                fresh_v.append(v[near])
            row, node = np.concatenate(fresh_r), np.concatenate(fresh_v)
            all_r.append(row)
            all_v.append(node)
        row, node = np.concatenate(all_r), np.concatenate(all_v)
        whole = many > max(FOLLOW, n // 32)
        return row[~whole[row]], node[~whole[row]], np.flatnonzero(whole)

    def entries(self, q: np.ndarray, present: int, count: int = 4) -> np.ndarray:
        """Best nodes of the top layer, compared with all of it."""
        top = min(self.sizes[-1], present)
        s = q @ self.x[:top].T
        return np.argsort(-s, axis=1, kind="stable")[:, :min(count, top)].astype(np.int32)

    def near(self, q: np.ndarray, ef: int, above: float):
        """For up to ``BATCH`` rows: ``(row, node)`` of the nodes found at least ``above`` similar,
        and the rows that have too many to follow."""
        entry = self.entries(q, self.n)
        for layer in range(len(self.sizes) - 1, 0, -1):
            entry = self.beam(layer, q, entry, 8)[0][:, :4]
        return self.beam(0, q, entry, min(ef, self.n), above)

    # -- build

    def _select(self, base: np.ndarray, cand: np.ndarray, width: int) -> np.ndarray:
        """Of every row's candidates up to ``width``: those closer to the row than to any one
        taken before, then the closest of the rest."""
        n, out = self.n, np.full((len(cand), width), self.n, np.int32)
        for lo in range(0, len(cand), BATCH):
            c = cand[lo:lo + BATCH]
            v = self.x[c]
            s = np.where(c < n, np.einsum("ijk,ik->ij", v, base[lo:lo + BATCH]), -2.0)
            by = np.argsort(-s, axis=1, kind="stable")
            c, s = np.take_along_axis(c, by, 1), np.take_along_axis(s, by, 1)
            v = np.take_along_axis(v, by[:, :, None], 1)
            between = v @ v.transpose(0, 2, 1)
            taken = np.zeros(c.shape, bool)
            for t in range(c.shape[1]):
                hidden = (taken[:, :t] & (between[:, t, :t] >= s[:, t, None])).any(1)
                taken[:, t] = (c[:, t] < n) & ~hidden & (taken[:, :t].sum(1) < width)
            rank = np.where(taken, 0, np.where(c < n, 1, 2))
            order = np.argsort(rank, axis=1, kind="stable")[:, :width]
            got = np.take_along_axis(c, order, 1)
            out[lo:lo + BATCH, :got.shape[1]] = got
        return out

    def _link(self, layer: int, new: np.ndarray, chosen: np.ndarray) -> None:
        n, adj = self.n, self.adj[layer]
        adj[new, :chosen.shape[1]] = chosen
        r, k = np.nonzero(chosen < n)
        i, j = new[r], chosen[r, k]
        s = np.einsum("ij,ij->i", self.x[i], self.x[j])
        by = np.lexsort((-s, j))
        i, j = i[by], j[by]
        to, first, count = np.unique(j, return_index=True, return_counts=True)
        rank = np.arange(len(j)) - np.repeat(first, count)
        stay = rank < CAP
        i, rank, at = i[stay], rank[stay], np.repeat(np.arange(len(to)), count)[stay]
        have = (adj[to] < n).sum(1)
        full = have + np.minimum(count, CAP) > CAP
        easy = ~full[at]
        adj[to[at[easy]], have[at[easy]] + rank[easy]] = i[easy]
        if full.any():
            cand = np.full((len(to), 2 * CAP), n, np.int32)
            cand[:, :CAP] = adj[to]
            cand[at, CAP + rank] = i
            some = to[full]
            keep = self._select(self.x[some], cand[full], WIDTH)
            adj[some] = n
            adj[some, :WIDTH] = keep

    def _build(self) -> None:
        a = 0
        while a < self.n:
            b = min(self.n, a + (BATCH if a < 4 * BATCH else 2 * BATCH))
            q = self.x[a:b]
            # batch members see the earlier ones of their batch by comparison
            s = np.where(np.tri(b - a, k=-1, dtype=bool), q @ q.T, -2.0)
            count = min(b - a, EF_BUILD if a == 0 else 8)
            mates = np.argsort(-s, axis=1, kind="stable")[:, :count]
            mates = np.where(np.take_along_axis(s, mates, 1) > -2.0, a + mates, self.n).astype(np.int32)
            entry = self.entries(q, a) if a else None
            for layer in range(len(self.sizes) - 1, -1, -1):
                size = self.sizes[layer]
                member = np.arange(a, b) < size
                found = None
                if a:
                    ids, _ = self.beam(layer, q, entry, EF_BUILD if member.any() else 8)
                    entry, found = ids[:, :4], ids
                if member.any():
                    near = np.where(mates < size, mates, self.n)
                    cand = near if found is None else np.concatenate([found, near], 1)
                    self._link(layer, np.arange(a, b)[member], self._select(q[member], cand[member], M))
            a = b


def scan(graph: Graph, q: np.ndarray, threshold: float):
    """All ``(row, node)`` with cosine >= threshold by comparing with the whole shard."""
    rows, nodes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for lo in range(0, len(q), 64):
        r, v = np.nonzero(q[lo:lo + 64] @ graph.exact.T >= threshold)
        rows.append(lo + r)
        nodes.append(v)
    return np.concatenate(rows), np.concatenate(nodes)


def links_of(graph: Graph, q: np.ndarray, ef: int, threshold: float):
    """Verified ``(row, node)`` of up to ``BATCH`` rows with cosine >= threshold (double precision)."""
    row, node, whole = graph.near(q.astype(np.float32), ef, threshold - MARGIN)
    good = np.concatenate([np.einsum("ij,ij->i", q[row[i:i + 100_000]], graph.exact[node[i:i + 100_000]]) for i in range(0, len(row) or 1, 100_000)]) >= threshold
    r, v = scan(graph, q[whole], threshold)
    return np.concatenate([row[good], whole[r]]), np.concatenate([node[good], v])


def probed_beam(graph: Graph, threshold: float) -> int:
    """Smallest doubled beam with which probes just above the threshold find their origin."""
    rng = np.random.default_rng(7)
    origin = np.unique(np.linspace(0, graph.n - 1, PROBES).astype(np.int64))
    x = graph.exact[origin]
    if x.shape[1] == 1:
        return EF_QUERY         # two directions only
    aim = min(threshold + 0.005, 1.0)
    away = rng.normal(size=x.shape)
    away = unit(away - (away * x).sum(1, keepdims=True) * x + 1e-30)
    q = unit(aim * x + np.sqrt(1 - aim * aim) * away)
    ef = EF_QUERY
    while ef < graph.n:
        row, node = links_of(graph, q, ef, threshold)
        if (node == origin[row]).sum() >= PROBE_RECALL * len(origin):
            break
        ef *= 2
    return ef


def spanning(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Positions of links ``(a, b)`` that join what all of them join, fewer than ends."""
    names, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = ends[:len(a)], ends[len(a):]
    label, keep, e = np.arange(len(names)), [np.empty(0, np.int64)], np.arange(len(a))
    while True:
        hi, lo = np.maximum(label[u[e]], label[v[e]]), np.minimum(label[u[e]], label[v[e]])
        cross = hi != lo
        e, hi, lo = e[cross], hi[cross], lo[cross]
        if not len(e):
            return np.concatenate(keep)
        by = np.lexsort((lo, hi))
        root, first = np.unique(hi[by], return_index=True)
        keep.append(e[by[first]])
        up = np.arange(len(names))
        up[root] = lo[by[first]]
        while (up[up] != up).any():
            up = up[up]
        label = up[label]


# ------------------------------------------------------------------------ Spark

def _matrix(col: pa.ChunkedArray) -> np.ndarray:
    lists = pa.concat_arrays(col.chunks)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


_INDEX = pa.schema([("dim", pa.int32()), ("shard", pa.int32()), ("ef", pa.int32()), ("rids", pa.binary()), ("weights", pa.binary()),
                    ("vectors", pa.binary()), ("layers", pa.list_(pa.binary()))])


def _index(threshold: float):
    def build(key, t):
        rids = t.column("rid").to_numpy()
        by = np.argsort(C.mix(rids.astype(np.uint64)), kind="stable")
        vectors = unit(_matrix(t.column("embedding"))[by])
        graph = Graph(vectors)
        row = {"dim": key[0].as_py(), "shard": key[1].as_py(), "ef": probed_beam(graph, threshold), "rids": rids[by].tobytes(),
               "weights": t.column("w").to_numpy()[by].tobytes(), "vectors": vectors.tobytes(), "layers": [C.pack_raw(a) for a in graph.adj]}
        return pa.Table.from_pylist([row], schema=_INDEX)
    return build


def _query(threshold: float):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def run(key, left, right):
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        ix = right.to_pylist()[0]
        rids, weights = np.frombuffer(ix["rids"], np.int64), np.frombuffer(ix["weights"], np.int64)
        vectors = np.frombuffer(ix["vectors"], np.float64).reshape(len(rids), -1)
        graph = Graph(vectors, [C.unpack_raw(b, np.int32).reshape(-1, CAP) for b in ix["layers"]])
        own = left.column("rid").to_numpy()
        q = unit(_matrix(left.column("embedding")))
        audited = C.mix(own.astype(np.uint64) + C._U(1)) % C._U(AUDIT_EVERY) == 0
        ef, passed = ix["ef"], False
        while not passed:
            n, ends = np.zeros(len(own), np.int64), (np.empty(0, np.int64), np.empty(0, np.int64))
            there = met = 0
            full = ef >= 2 * len(rids)
            for lo in range(0, len(own), BATCH):
                part = q[lo:lo + BATCH]
                row, node = scan(graph, part, threshold) if full else links_of(graph, part, ef, threshold)
                check = np.flatnonzero(audited[lo:lo + BATCH])
                r, v = scan(graph, part[check], threshold)
                there += len(r)
                met += int(np.isin(check[r] * len(rids) + v, row * len(rids) + node).sum())
                other = own[lo + row] != rids[node]
                row, node = lo + row[other], node[other]
                n += np.bincount(row, weights[node], minlength=len(own)).astype(np.int64)
                # only what still joins something is kept of the links
                a, b = (np.concatenate(z) for z in zip(ends, (own[row], rids[node])))
                tree = spanning(a, b)
                ends = a[tree], b[tree]
            passed = full or met >= AUDIT_RECALL * there
            ef *= 2
        some = np.flatnonzero(n)
        count = np.arange(len(some) + len(ends[0])) < len(some)
        zeros = lambda k: np.zeros(k, np.int64)
        return pa.table({"a": np.concatenate([own[some], ends[0]]), "b": pa.array(np.concatenate([zeros(len(some)), ends[1]]), mask=count),
                         "n": pa.array(np.concatenate([n[some], zeros(len(ends[0]))]), mask=~count)}, schema=schema)
    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, shard_rows: int = SHARD_ROWS, min_shards: int = MIN_SHARDS) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row of ``vectors (vec_id, embedding)``."""
    spark = vectors.sparkSession
    C.prepare(spark)
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    usable = F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    same = F.transform("embedding", lambda x: x + F.lit(0).cast("float"))        # one zero
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(usable, same).alias("embedding"))
    h1, h2 = F.xxhash64("embedding").alias("h1"), F.xxhash64("embedding", F.lit(1)).alias("h2")

    distinct = rows.where("embedding is not null").groupBy("embedding").agg(F.count(F.lit(1)).alias("w"), F.min("vec_id").alias("lead"))
    nodes = C.written(distinct.select(F.monotonically_increasing_id().alias("rid"), F.size("embedding").alias("dim"), "embedding", "w", "lead", h1, h2))
    n = nodes.count()
    shards = max(min_shards, -(-n // shard_rows))
    shard = F.pmod(F.xxhash64("rid"), F.lit(shards)).cast("int")
    index = C.written(nodes.select("dim", shard.alias("shard"), "rid", "w", "embedding").groupBy("dim", "shard")
                      .applyInArrow(_index(threshold), "dim int, shard int, ef int, rids binary, weights binary, vectors binary, layers array<binary>"))
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    block = F.pmod(F.xxhash64("rid", F.lit(7)), F.lit(shards)).cast("int")
    asked = nodes.select("dim", every.alias("shard"), block.alias("block"), "rid", "embedding").groupBy("dim", "shard", "block")
    found = C.written(asked.cogroup(index.withColumn("block", every).groupBy("dim", "shard", "block")).applyInArrow(_query(threshold), "a long, b long, n long"))

    links = found.where("b is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    comp = C.components(links)
    own = found.where("b is null").groupBy(F.col("a").alias("rid")).agg(F.sum("n").alias("n"))
    # a link that only the other end has found counts for both
    ends = links.select(F.col("a").alias("rid"), F.col("b").alias("other")).union(links.select("b", "a"))
    known = ends.join(nodes.select(F.col("rid").alias("other"), "w"), "other").groupBy("rid").agg(F.sum("w").alias("least"))
    counted = own.join(known, "rid", "full").select("rid", F.greatest(F.coalesce("n", F.lit(0)), F.coalesce("least", F.lit(0))).alias("n"))
    linked = (nodes.select("rid", "w", "lead", "h1", "h2").join(counted, "rid", "left").where("n is not null or w > 1")
              .join(comp.withColumnRenamed("id", "rid"), "rid", "left").withColumn("comp", F.coalesce("comp", "rid")))
    named = linked.groupBy("comp").agg(F.min("lead").alias("component"))
    facts = linked.join(named, "comp").select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"), "component")
    # vectors that link with nothing have no second hash, and no key in common
    none = F.col("embedding").isNull()
    keyed = rows.select("vec_id", F.when(none, F.xxhash64("vec_id")).otherwise(F.xxhash64("embedding")).alias("h1"),
                        F.when(~none, F.xxhash64("embedding", F.lit(1))).alias("h2"))
    is_linked = F.col("n_links").isNotNull()
    component = F.when(is_linked, F.col("component")).otherwise(F.col("vec_id"))
    return (keyed.join(facts, ["h1", "h2"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")))

"""Near-duplicate vectors by navigable small-world graphs: one graph per shard, every group of vectors asks every shard.

Within a shard, vectors nearer to an earlier one than ATTACH of the threshold's angle join its group; the first of each group
is a node of the graph. The searches only propose pairs of groups. By the triangle inequality of angles a pair of groups
whose members all lie near enough to their two centres is linked as a whole, one whose members are all too far apart is not,
and the members of the rest are compared in double precision. So a tight group costs its size, not its square.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import components, cut, discard

#: Cosine from which two vectors are linked.
THRESHOLD = 0.9
#: Shards at least, and vectors of a shard at most (more shards are made beyond it).
SHARDS, SHARD_ROWS = 8, 65_536
#: Tasks of a search at least, and groups that ask a shard in one task at most.
TASKS, BLOCK = 24, 131_072
#: Share of the threshold's angle within which a vector joins a group.
ATTACH = 0.7
#: Links of a node, and the factor by which each level is thinner than the one below.
LINKS, THIN = 24, 16
#: First width of the beams, the factor by which the beams of shards that fail the audit widen, and queries searched together.
BEAM, WIDER, TOGETHER = 32, 4, 256
#: Queries with more candidates than half of this beam, and shards that fail the audit at it, are compared whole, so many at once.
WIDEST, DENSE = 1024, 64
#: An audit holds so many vectors against all others and asks for this mean share of the links of each.
AUDIT, RECALL = 1024, 0.999
#: Vectors whose cosines with a whole group are worked out together.
PART = 512
#: Single-precision searches keep what is within this of a bound on the cosine; bounds on sums of angles keep this distance.
MARGIN, SLACK = 1e-4, 1e-6


def _choose(x: np.ndarray, of: np.ndarray, cand: np.ndarray, keep: int) -> np.ndarray:
    """For each node its ``keep`` links out of candidates (-1: none): near ones that lie in different directions first."""
    sims = np.einsum("bcd,bd->bc", x[cand], x[of])
    sims[cand < 0] = -2
    order = np.argsort(-sims, axis=1, kind="stable")
    cand, sims = np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1)
    again = np.zeros(cand.shape, bool)
    for j in range(1, cand.shape[1]):
        again[:, j] = (cand[:, :j] == cand[:, j : j + 1]).any(1)
    bad = again | (cand < 0)
    mutual = np.einsum("bcd,bed->bce", x[cand], x[cand])
    kept = np.zeros(cand.shape, bool)
    for j in range(cand.shape[1]):
        nearer = (mutual[:, j] > sims[:, [j]]) & kept
        kept[:, j] = ~bad[:, j] & ~nearer.any(1) & (kept.sum(1) < keep)
    rank = np.argsort(np.where(kept, 0, np.where(bad, 2, 1)), axis=1, kind="stable")[:, :keep]
    out = np.take_along_axis(cand, rank, 1)
    out[np.take_along_axis(bad, rank, 1)] = -1
    return np.pad(out, ((0, 0), (0, keep - out.shape[1])), constant_values=-1)


def beam(x: np.ndarray, links: np.ndarray, q: np.ndarray, entry: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Beam search of all queries at once: (nodes, cosines) of the best ``width`` in falling order, -1 where there are fewer."""
    b, n = len(q), len(links)
    seen = np.zeros((b, n), bool)
    rows = np.arange(b)[:, None]
    ids = np.full((b, width), -1)
    sims = np.full((b, width), -2.0, np.float32)
    done = np.ones((b, width), bool)
    k = entry.shape[1]
    ids[:, :k], done[:, :k] = entry, entry < 0
    sims[:, :k] = np.where(entry >= 0, np.einsum("bkd,bd->bk", x[entry], q), -2)
    seen[rows, np.maximum(entry, 0)] = True
    step = 4
    live = np.arange(b)
    while len(live):
        s = np.where(done[live], -3, sims[live])
        pick = np.argpartition(-s, min(step, width) - 1, axis=1)[:, :step]
        ok = ~np.take_along_axis(done[live], pick, 1)
        done[live[:, None], pick] = True
        nodes = np.where(ok, np.take_along_axis(ids[live], pick, 1), -1)
        near = np.where(nodes[:, :, None] >= 0, links[nodes], -1).reshape(len(live), -1)
        near[near >= n] = -1
        at = live[:, None]
        fresh = (near >= 0) & ~seen[at, np.maximum(near, 0)]
        order = np.argsort(near, axis=1, kind="stable")
        ordered = np.take_along_axis(near, order, 1)
        twice = np.zeros(near.shape, bool)
        np.put_along_axis(twice, order[:, 1:], ordered[:, 1:] == ordered[:, :-1], 1)
        fresh &= ~twice
        r, c = np.nonzero(fresh)
        new = np.full(near.shape, -2.0, np.float32)
        new[r, c] = np.einsum("rd,rd->r", x[near[r, c]], q[live[r]])
        seen[live[r], near[r, c]] = True
        all_ids = np.concatenate([ids[live], near], 1)
        all_sims = np.concatenate([sims[live], new], 1)
        all_done = np.concatenate([done[live], ~fresh], 1)
        best = np.argsort(-all_sims, axis=1, kind="stable")[:, :width]
        ids[live] = np.take_along_axis(all_ids, best, 1)
        sims[live] = np.take_along_axis(all_sims, best, 1)
        done[live] = np.take_along_axis(all_done, best, 1) | (sims[live] <= -2)
        live = live[~done[live].all(1)]
    ids[sims <= -2] = -1
    return ids, sims


def descend(x: np.ndarray, levels: list[np.ndarray], q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Search from the thinnest level, whose nodes are all compared, down to level 0 (the last of ``levels``)."""
    top = len(levels[0])
    s = q @ x[:top].T
    entry = np.argsort(-s, axis=1)[:, : min(4, top)]
    for links in levels[:-1]:
        entry = beam(x, links, q, entry, 8)[0][:, :4]
    return beam(x, levels[-1], q, entry, width)


def build(x: np.ndarray) -> list[np.ndarray]:
    """Levels of a graph over ``x`` (unit rows in hash order), thinnest first: level l has the first n / THIN**l rows."""
    sizes = [len(x)]
    while sizes[-1] > 4 * THIN:
        sizes.append(sizes[-1] // THIN)
    levels: list[np.ndarray] = []
    for n in reversed(sizes):
        links = np.full((n, LINKS), -1)
        start = 0
        while start < n:
            end = min(n, start + min(TOGETHER, max(32, start)))
            q = x[start:end]
            inside = q @ q.T
            np.fill_diagonal(inside, -2)
            k = min(LINKS, end - start)
            cand = start + np.argsort(-inside, axis=1)[:, :k]
            cand[np.take_along_axis(inside, cand - start, 1) <= -2] = -1
            if start:
                upper = [u for u in levels if len(u) <= start] or [links[: min(start, 4 * THIN)]]
                found = descend(x, [*upper, links[:start]], q, BEAM)[0]
                cand = np.concatenate([cand, found], 1)
            of = np.arange(start, end)
            links[start:end] = _choose(x, of, cand, LINKS)
            src = np.repeat(of, LINKS)
            dst = links[start:end].reshape(-1)
            good = dst >= 0
            src, dst = src[good], dst[good]
            order = np.lexsort((-np.einsum("rd,rd->r", x[src], x[dst]), dst))
            src, dst = src[order], dst[order]
            to, first, many = np.unique(dst, return_index=True, return_counts=True)
            nth = np.arange(len(dst)) - np.repeat(first, many)
            more = np.full((len(to), LINKS), -1)
            use = nth < LINKS
            more[np.repeat(np.arange(len(to)), many)[use], nth[use]] = src[use]
            links[to] = _choose(x, to, np.concatenate([links[to], more], 1), LINKS)
            start = end
        levels.append(links)
    return levels


def near_nodes(x: np.ndarray, levels: list[np.ndarray], q: np.ndarray, least: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(queries, nodes, cosines) of at least ``least`` of the query.

    A beam of which more than half is near enough is widened; beyond WIDEST the query is compared with all nodes, and with a
    width of 0 all queries are.
    """
    for a in range(0, len(q), TOGETHER):
        open_, w = np.arange(a, min(len(q), a + TOGETHER)), min(width, len(x))
        while len(open_) and 0 < w <= max(width, WIDEST):
            ids, sims = descend(x, levels, q[open_], w)
            hit = (sims >= least[open_, None]) & (ids >= 0)
            full = (hit.sum(1) * 2 > w) & (w < len(x))
            r, c = np.nonzero(hit & ~full[:, None])
            yield open_[r], ids[r, c], sims[r, c]
            open_, w = open_[full], min(2 * w, len(x))
        for i in range(0, len(open_), DENSE):
            part = open_[i : i + DENSE]
            sims = q[part] @ x.T
            r, c = np.nonzero(sims >= least[part, None])
            yield part[r], c, sims[r, c]


def leaders(x: np.ndarray, least: float) -> np.ndarray:
    """For each row the first earlier row that leads a group and has a cosine of ``least`` or more, or the row itself."""
    own = np.arange(len(x))
    lead = np.zeros(0, np.int64)
    for a in range(0, len(x), PART):
        q = x[a : a + PART]
        best = np.full(len(q), -1)
        if len(lead):
            sims = q @ x[lead].T
            top = sims.argmax(1)
            best = np.where(sims[np.arange(len(q)), top] >= least, lead[top], -1)
        free = np.flatnonzero(best < 0)
        inside = q[free] @ q[free].T >= least
        first: list[int] = []
        for i in range(len(free)):
            near = np.flatnonzero(inside[i, first]) if first else ()
            if len(near):
                best[free[i]] = a + free[first[near[0]]]
            else:
                first.append(i)
                best[free[i]] = a + free[i]
        own[a : a + PART] = best
        lead = np.concatenate([lead, a + free[first]]) if first else lead
    return own


def _matrix(v) -> np.ndarray:
    return np.stack([np.frombuffer(x, np.float64) for x in v]) if len(v) else np.zeros((0, 1))


def _unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _angle(cosine):
    return np.arccos(np.clip(cosine, -1.0, 1.0))


def _encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for e in b["embedding"]:
            v = None if e is None else np.array([np.nan if z is None else z for z in e], np.float64)
            ok = v is not None and len(v) and np.isfinite(v).all() and v.any()
            out.append((v + 0.0).tobytes() if ok else None)
        yield pd.DataFrame({"vec_id": b["vec_id"], "v": out})


GROUPS = (
    "dim int, shard int, pos int, g long, lead binary, reach double, near array<binary>, center binary, radius double, n long, "
    "reps array<long>, many array<long>, vectors binary"
)


def _grouped(threshold: float):
    """The groups of a shard, each with its node of the graph: ``g`` is the least representative of the group, ``reach`` the
    radius about the centre and the angle between centre and node, ``vectors`` the unit vectors of the members."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["turn", "rep"])
        x = _unit(_matrix(part["v"]))
        rep, many = part["rep"].to_numpy(), part["n"].to_numpy()
        lead = leaders(x.astype(np.float32), math.cos(ATTACH * math.acos(threshold)))
        order = np.argsort(lead, kind="stable")
        nodes, first = np.unique(lead[order], return_index=True)
        levels = build(x[nodes].astype(np.float32))
        rows = []
        for i, own in enumerate(np.split(order, first[1:])):
            center = _unit(x[own].sum(0, keepdims=True))[0] if len(own) > 1 else x[own[0]]
            radius = float(_angle(x[own] @ center).max()) if len(own) > 1 else 0.0
            off = float(_angle(x[nodes[i]] @ center)) if len(own) > 1 else 0.0
            rows.append((
                i, int(rep[own].min()), x[nodes[i]].tobytes(), radius + off, [u[i].astype(np.int32).tobytes() for u in levels if i < len(u)],
                center.tobytes(), radius, int(many[own].sum()), rep[own], many[own], x[own].tobytes(),
            ))
        out = pd.DataFrame(rows, columns=["pos", "g", "lead", "reach", "near", "center", "radius", "n", "reps", "many", "vectors"])
        return out.assign(dim=part["dim"].iloc[0], shard=part["shard"].iloc[0])[[f.split()[0] for f in GROUPS.split(", ")]]

    return run


def _asked(threshold: float):
    """Pairs (g, h), g < h, of groups of one shard and of one block of queries that may have linked members."""
    bound = math.acos(threshold)

    def run(graph: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        pairs = [np.zeros((0, 2), np.int64)]
        if len(graph) and len(ask):
            graph = graph.sort_values("pos")
            deep = int(graph["near"].map(len).max())
            levels = [np.stack([np.frombuffer(x[k - deep], np.int32) for x in graph["near"] if len(x) >= deep - k]) for k in range(deep)]
            x, q = (_matrix(t["lead"]).astype(np.float32) for t in (graph, ask))
            g, h, reach, own = graph["g"].to_numpy(), ask["g"].to_numpy(), graph["reach"].to_numpy(), ask["reach"].to_numpy()
            least = np.cos(np.minimum(bound + own + reach.max(), math.pi)).astype(np.float32) - np.float32(MARGIN)
            for r, c, sims in near_nodes(x, levels, q, least, int(ask["width"].iloc[0])):
                ok = (h[r] != g[c]) & (sims >= np.cos(np.minimum(bound + own[r] + reach[c], math.pi)) - MARGIN)
                pairs.append(np.stack([np.minimum(h[r[ok]], g[c[ok]]), np.maximum(h[r[ok]], g[c[ok]])], 1))
        return pd.DataFrame(np.unique(np.concatenate(pairs), axis=0), columns=["g", "h"])

    return run


def _judged(threshold: float):
    """(g, h, all): whether all members of two groups are linked; pairs without links are left out, open ones have null."""
    bound = math.acos(threshold)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            apart = _angle(np.array([np.frombuffer(x) @ np.frombuffer(y) for x, y in zip(b["g_center"], b["h_center"])], np.float64))
            both = b["g_radius"].to_numpy() + b["h_radius"].to_numpy()
            every = apart + both <= bound - SLACK
            some = every | (apart - both <= bound + SLACK)
            yield pd.DataFrame({"g": b["g"], "h": b["h"], "every": pd.array(np.where(every, True, None), "boolean")})[some]

    return run


def _linked(x: np.ndarray, y: np.ndarray, center: np.ndarray, radius: float, n: np.ndarray, threshold: float) -> np.ndarray:
    """For each x the weights ``n`` of the y it is linked to: all or none where the angle to their centre tells, else compared."""
    bound = math.acos(threshold)
    apart = _angle(x @ center)
    out = np.where(apart + radius <= bound - SLACK, n.sum(), 0)
    open_ = np.flatnonzero((apart + radius > bound - SLACK) & (apart - radius <= bound + SLACK))
    for i in range(0, len(open_), PART):
        for j in range(0, len(y), 8 * PART):
            out[open_[i : i + PART]] += (x[open_[i : i + PART]] @ y[j : j + 8 * PART].T >= threshold) @ n[j : j + 8 * PART]
    return out


def _compared(threshold: float):
    """(g, h, rep, links) of open pairs: the links of each member of either group that has one. Pairs (g, g) are a group's own."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                x, y = (np.frombuffer(v).reshape(len(k), -1) for v, k in ((r.g_vectors, r.g_reps), (r.h_vectors, r.h_reps)))
                sides = [(r.g_reps, _linked(x, y, np.frombuffer(r.h_center), r.h_radius, np.asarray(r.h_many), threshold))]
                if r.g == r.h:
                    sides[0][1][:] -= np.asarray(r.g_many)
                else:
                    sides.append((r.h_reps, _linked(y, x, np.frombuffer(r.g_center), r.g_radius, np.asarray(r.g_many), threshold)))
                for reps, links in sides:
                    have = np.flatnonzero(links)
                    yield pd.DataFrame({"g": r.g, "h": r.h, "rep": np.asarray(reps)[have], "links": links[have]})

    return run


def _audited(sample: list[tuple[int, bytes]], threshold: float):
    """(a, g, shard, links): the links of each sampled vector in each group, copies of the vector itself left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = {dim: [i for i, x in enumerate(sample) if len(x[1]) == dim] for dim in {len(x[1]) for x in sample}}
        unit = {dim: _unit(_matrix([sample[i][1] for i in at])) for dim, at in own.items()}
        ids = np.array([x[0] for x in sample], np.int64)
        for b in batches:
            for dim, part in b.groupby("dim"):
                if dim not in own:
                    continue
                size = part["reps"].map(len).to_numpy()
                reps = np.concatenate(part["reps"].to_list())
                v = np.concatenate([np.frombuffer(x).reshape(-1, dim // 8) for x in part["vectors"]])
                place = np.repeat(np.arange(len(part)), size)
                hit = unit[dim] @ v.T >= threshold
                hit &= ids[own[dim]][:, None] != reps
                r, c = np.nonzero(hit)
                one = pd.DataFrame({"a": ids[own[dim]][r], "at": place[c]}).value_counts().rename("links").reset_index()
                yield pd.DataFrame({"a": one["a"], "g": part["g"].to_numpy()[one["at"]], "shard": part["shard"].to_numpy()[one["at"]], "links": one["links"]})

    return run


def find_pairs(groups: DataFrame, members: DataFrame, n: int, shards: int, threshold: float, recall: float) -> DataFrame:
    """(g, h), g < h: pairs of groups that may have linked members.

    Each group asks every shard. The audit takes AUDIT vectors by hash, compares them with all others, and asks whether the
    pair of groups of each link was proposed; the mean share over the vectors that have links must reach ``recall``. Where it
    doesn't, the shards at either end of a missing pair are asked again by WIDER beams, and compared whole in the end.
    """
    spark = groups.sparkSession
    blocks = max(math.ceil(TASKS / shards), math.ceil(n / BLOCK))
    graph = groups.select("dim", "shard", "pos", "g", "lead", "reach", "near")
    # aliases, so that the two sides of the search don't share columns
    asks = groups.select(*[F.col(c).alias(c) for c in ("dim", "g", "lead", "reach")], F.pmod(F.xxhash64("g"), F.lit(blocks)).cast("int").alias("block"))
    sample = members.orderBy(F.xxhash64("rep"), "rep").select("rep", "v").limit(AUDIT).collect()
    truth = groups.select("dim", "shard", "g", "reps", "vectors").mapInPandas(_audited([(r.rep, bytes(r.v)) for r in sample], threshold), "a long, g long, shard int, links long")
    own = members.select(F.col("rep").alias("a"), F.col("g").alias("own"), F.col("shard").alias("own_shard"))
    truth = cut(truth.join(own, "a").select("a", "shard", "own_shard", "links", F.least("g", "own").alias("g"), F.greatest("g", "own").alias("h")))
    pairs, widths = None, dict.fromkeys(range(shards), BEAM)
    while True:
        ask = F.broadcast(spark.createDataFrame(list(widths.items()), "shard int, width int"))
        own = F.broadcast(spark.createDataFrame([(k,) for k in range(blocks)], "block int"))
        found = (
            graph.join(ask.select("shard"), "shard").join(own).groupBy("dim", "shard", "block")
            .cogroup(asks.join(ask).groupBy("dim", "shard", "block"))
            .applyInPandas(_asked(threshold), "g long, h long")
        )
        old = pairs
        pairs = cut((found if old is None else found.unionByName(old)).distinct())
        discard(old)
        seen = truth.join(pairs.withColumn("found", F.lit(True)), ["g", "h"], "left").withColumn("found", (F.col("g") == F.col("h")) | F.coalesce("found", F.lit(False)))
        share = seen.groupBy("a").agg((F.sum(F.when(F.col("found"), F.col("links")).otherwise(0)) / F.sum("links")).alias("share")).agg(F.avg("share")).first()[0]
        if share is None or share >= recall:
            return pairs
        missed = seen.where(~F.col("found")).select(F.explode(F.array("shard", "own_shard")).alias("shard")).distinct().collect()
        wider = lambda w: 0 if not w or w * WIDER > WIDEST else w * WIDER
        widths = {r.shard: wider(widths.get(r.shard, BEAM)) for r in missed}


def find_links(classes: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(rep, near, root) of the representatives of ``classes`` (rep, n, v, dim): the vectors linked to each, every class
    counted n times, and the least representative of its component. Nothing here grows with the pairs of a tight group."""
    n = classes.count()
    shards = max(SHARDS, math.ceil(n / SHARD_ROWS))
    placed = classes.withColumn("turn", F.xxhash64("v")).withColumn("shard", F.pmod("turn", F.lit(shards)).cast("int"))
    groups = cut(placed.groupBy("dim", "shard").applyInPandas(_grouped(threshold), GROUPS))
    each = groups.select("g", "shard", "dim", "n", "radius", F.posexplode("reps").alias("at", "rep"), "many", "vectors")
    members = cut(each.select("rep", "g", "shard", "n", "radius", F.element_at("many", F.col("at") + 1).alias("own"), F.expr("substring(vectors, at * dim + 1, dim)").alias("v")))
    pairs = find_pairs(groups, members, n, shards, threshold, recall)

    def side(x: str, *names: str) -> DataFrame:
        return groups.select(F.col("g").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in names])

    judged = pairs.join(side("g", "center", "radius"), "g").join(side("h", "center", "radius"), "h")
    judged = cut(judged.select("g", "h", "g_center", "h_center", "g_radius", "h_radius").mapInPandas(_judged(threshold), "g long, h long, every boolean"))
    tight = F.col("radius") * 2 <= math.acos(threshold) - SLACK
    loose = groups.where((F.size("reps") > 1) & ~tight).select("g", F.col("g").alias("h"))
    heavy = ("center", "radius", "reps", "many", "vectors")
    open_ = judged.where("every IS NULL").select("g", "h").unionByName(loose)
    compared = cut(
        open_.join(side("g", *heavy), "g").join(side("h", *heavy), "h").mapInPandas(_compared(threshold), "g long, h long, rep long, links long"), 64
    )
    whole = judged.where("every")
    weights = groups.select(F.col("g").alias("other"), "n")
    by_group = (
        whole.select("g", F.col("h").alias("other")).unionByName(whole.select(F.col("h").alias("g"), F.col("g").alias("other")))
        .join(weights, "other").groupBy("g").agg(F.sum("n").alias("by_group"))
    )
    by_rep = compared.groupBy("rep").agg(F.sum("links").alias("by_rep"))
    edges = whole.select(F.col("g").alias("a"), F.col("h").alias("b")).unionByName(compared.where("g <> h").select(F.col("g").alias("a"), F.col("h").alias("b")))
    roots = components(edges).withColumnRenamed("node", "g")
    near = F.when(tight, F.col("n") - F.col("own")).otherwise(0) + F.coalesce("by_group", F.lit(0)) + F.coalesce("by_rep", F.lit(0))
    return (
        members.join(by_group, "g", "left").join(by_rep, "rep", "left").join(roots, "g", "left")
        .select("rep", near.alias("near"), F.coalesce("root", "g").alias("root"))
    )


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each vector: vec_id, n_links, component_id, kept.

    Two vectors are linked if their cosine, in double precision, is ``threshold`` or more. Equal vectors are compared as
    one class and counted as often as they occur. Vectors that are null, empty, zero, or hold null or non-finite
    components link with nothing, nor do vectors of different lengths. A null vec_id gives no links, a null component and
    kept false. Repeated rows count as vectors of their own. Other columns are ignored; an empty table gives an empty one.
    """
    rows = cut(vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInPandas(_encoded, "vec_id long, v binary"))
    classes = cut(
        rows.where("v IS NOT NULL AND vec_id IS NOT NULL").groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
        .withColumn("dim", F.octet_length("v"))
    )
    found = classes.join(find_links(classes, threshold), "rep")
    known = found.select("v", (F.col("n") - 1 + F.col("near")).alias("n_links"), F.col("root").alias("component_id"))
    alone = rows.where("v IS NULL OR vec_id IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = rows.where("v IS NOT NULL AND vec_id IS NOT NULL").join(known, "v").select("vec_id", "n_links", "component_id").unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def query(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))

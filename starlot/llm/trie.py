"""Prefix trie of conversations: which openings are shared, by how many, and what sharing saves.

Every conversation is rebuilt first (``rebuilt_turns``), then each distinct opening of d turns is a node. An
opening is known by a chain of digests, so texts never move: a turn is its role and a digest. All
that holds of one node alone (members, children, size of its subtree) is counted by plain aggregates.

What adds up over subtrees is rolled up by centroid decomposition of the parent edges, whose depth is
logarithmic however long a conversation is. The nodes of a component whose subtree holds at least half of it
form the path from its top down to its centroid, so one comparison finds both. A round aggregates the component's
total from the centroid down, adds it along the centroid-to-top path, and cuts: the centroid is
done, each of its children is the top of a component, and what is left above is one more. Components of more
than ``bound`` nodes are split by Spark, all at once; a smaller one goes on by the same steps in one task. Whether a
node lies below a centroid is a join: its smallest member must pass from the centroid to one of its children.

The root, parent of all first turns, is left out of the components and summed from their tops. The members
that end in a node are gathered in chunks of ids, so that no row or task holds all ends of a common
conversation; the chunks stream through the digest in order.

Defined cases: null roles and texts are empty; rows of one turn stand by role, then by the digest of the
text; repeated rows are turns of their own; rows without a conv_id belong to no conversation and are left
out; an empty table has no node, not even a root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starlot.llm.common import sql_crc32, text_or_empty
from starlot.session import materialise, shared_folder

# Nodes of a component that one task finishes.
BOUND = 10_000
# Ids of a chunk of members.
CHUNK = 65_536
# Fixed values of the rebuilding rule: conversations share openings in groups of five, of up to eight turns.
GROUP, SHARED = 5, 9
ROOT = hashlib.md5(b"").digest()
NO_ENDS = hashlib.sha256().hexdigest()


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conv, part, pos, step, bytes)`` of the turns that make up each conversation, and all ``conv``.

    A conversation opens with the first h turns of its group's first one (part 0) and goes on with
    its own after its first h (part 1).
    """
    role, text = text_or_empty("role"), text_or_empty("text")
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv"), "turn", role.alias("role"), F.md5(text).alias("t"), F.octet_length(text).alias("bytes")
    )
    place = F.row_number().over(Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "role", "t")) - 1
    step = F.unhex(F.md5(F.concat("t", "role")))
    rows = rows.select("conv", place.alias("pos"), step.alias("step"), F.col("bytes").cast("bigint").alias("bytes"))
    shared = lambda conv: F.crc32(conv.cast("string").cast("binary")) % SHARED
    every = rows.select("conv").distinct()
    wanted = every.select(F.col("conv").alias("c"), (F.col("conv") - F.col("conv") % GROUP).alias("of"), shared(F.col("conv")).alias("h"))
    opening = rows.where(F.col("pos") < SHARED - 1).join(wanted, (F.col("conv") == F.col("of")) & (F.col("pos") < F.col("h")))
    own = rows.where(F.col("pos") >= shared(F.col("conv")))
    columns = ["pos", "step", "bytes"]
    turns = opening.select(F.col("c").alias("conv"), F.lit(0).alias("part"), *columns)
    return turns.unionByName(own.select("conv", F.lit(1).alias("part"), *columns)), every


def _chained(conv: int, turns: list[tuple[bytes, int]]) -> Iterator[tuple]:
    key = top = ROOT
    for depth, (step, size) in enumerate(turns, 1):
        parent, key = key, hashlib.md5(key + step).digest()
        top = key if depth == 1 else top
        yield conv, depth, key, parent, top, size, len(turns)


def _chains(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The nodes each conversation passes; rows come by conversation, in order."""
    columns = ["conv", "depth", "key", "parent", "top", "bytes", "length"]
    conv, turns = None, []
    for batch in rows:
        out = []
        for c, step, size in zip(batch["conv"], batch["step"], batch["bytes"]):
            if c != conv:
                out += _chained(conv, turns)
                conv, turns = c, []
            turns.append((step, size))
        yield pd.DataFrame(out, columns=columns)
    yield pd.DataFrame(list(_chained(conv, turns)), columns=columns)


def _nodes(passes: DataFrame, folder: str) -> DataFrame:
    """One row a node: ``(key, parent, top, depth, bytes, conv, n_convs, size)``."""
    about = ["key", "parent", "top", "depth", "bytes"]
    nodes = materialise(passes.groupBy(*about).agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs")), f"{folder}/distinct")
    # A conversation is the smallest member of its nodes from some depth on; they are counted in all it passes.
    owned = nodes.groupBy(F.col("conv").alias("owner")).agg(F.min("depth").alias("since"))
    below = F.col("length") - F.greatest("since", "depth") + 1
    sizes = passes.join(owned, F.col("conv") == F.col("owner")).groupBy(F.col("key").alias("s_key")).agg(F.sum(below).alias("size"))
    return nodes.join(sizes, F.col("key") == F.col("s_key")).drop("s_key")


def decompose(parents: list[int], values: list[tuple[int, ...]], sizes: list[int]) -> list[tuple[int, ...]]:
    """Subtree sums of a tree by centroid decomposition; node 0 is the top, ``parents`` are indices.

    ``values`` holds, by node, what it counts itself; ``sizes`` the nodes of its subtree.
    """
    children: list[list[int]] = [[] for _ in parents]
    for node, parent in enumerate(parents):
        if node:
            children[parent].append(node)
    width, sizes = len(values[0]), list(sizes)
    added = [[0] * width for _ in parents]
    tops = [0]
    while tops:
        top = centroid = tops.pop()
        half, path = sizes[top], []
        while True:
            heavy = next((k for k in children[centroid] if 2 * sizes[k] >= half), None)
            if heavy is None:
                break
            path.append(centroid)
            centroid = heavy
        total, below = [0] * width, [centroid]
        while below:
            node = below.pop()
            below += children[node]
            for i in range(width):
                total[i] += values[node][i]
        for node in [*path, centroid]:
            for i in range(width):
                added[node][i] += total[i]
        for node in path:
            sizes[node] -= sizes[centroid]
        if path:
            children[path[-1]].remove(centroid)
            tops.append(top)
        tops += children[centroid]
        children[centroid] = []
    return [tuple(x) for x in added]


def _finished(rows: Iterator[pd.DataFrame], sums: list[str]) -> Iterator[pd.DataFrame]:
    """``(key, sums)`` of whole components; rows come by component, tops first."""
    def totals(part: pd.DataFrame) -> Iterator[tuple]:
        index = {key: i for i, key in enumerate(part["key"])}
        parents = [index.get(p, 0) for p in part["parent"]]
        values = list(zip(*[part[s] for s in sums]))
        found = decompose(parents, values, list(part["size"]))
        for key, total, *more in zip(part["key"], found, *[part[f"more_{s}"] for s in sums]):
            yield key, *[a + b for a, b in zip(total, more)]

    rest = None
    for batch in rows:
        whole = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        last = whole["comp"] == whole["comp"].iloc[-1] if len(whole) else []
        rest, out = whole[last], []
        for _, part in whole[~last].groupby("comp", sort=False) if len(whole) else ():
            out += totals(part)
        yield pd.DataFrame(out, columns=["key", *sums])
    if rest is not None and len(rest):
        yield pd.DataFrame(list(totals(rest)), columns=["key", *sums])


def _plus(name: str, more: Column) -> Column:
    return (F.col(f"more_{name}") + more).alias(f"more_{name}")


def subtree_sums(nodes: DataFrame, passes: DataFrame, sums: list[str], folder: str, bound: int = BOUND) -> DataFrame:
    """``(key, sums)``: the columns ``sums`` of ``nodes`` added up over the subtree of each node.

    ``nodes`` has ``key, parent, top, depth, conv, size``; ``passes`` has a row for each
    conversation and node on its way.
    """
    state = nodes.select(
        "key", "parent", F.col("top").alias("comp"), "depth", "conv", "size", *sums, *[F.lit(0).cast("bigint").alias(f"more_{s}") for s in sums]
    )
    columns, small, done, round_ = state.columns, [], [], 0
    steps = passes.select(F.col("conv").alias("p_conv"), F.col("parent").alias("p_parent"), F.col("key").alias("p_child"))
    while True:
        state = materialise(state, f"{folder}/state{round_}")
        large = state.where((F.col("key") == F.col("comp")) & (F.col("size") > bound)).select(F.col("comp").alias("l_comp"), F.col("size").alias("l_size"))
        if large.isEmpty():
            break
        small.append(state.join(large, F.col("comp") == F.col("l_comp"), "left_anti"))
        split = state.join(large, F.col("comp") == F.col("l_comp"))
        centroid = split.where(2 * F.col("size") >= F.col("l_size")).groupBy("comp").agg(F.min(F.struct("size", "depth", "key")).alias("c"))
        centroid = centroid.select(F.col("comp").alias("c_comp"), F.col("c.key").alias("c_key"), F.col("c.depth").alias("c_depth"), F.col("c.size").alias("c_size"))
        centroid = materialise(centroid, f"{folder}/centroid{round_}")
        through = steps.join(centroid.select(F.col("c_key").alias("t_key"), F.col("c_comp").alias("t_comp")), F.col("p_parent") == F.col("t_key"))
        below = split.join(centroid, F.col("comp") == F.col("c_comp")).join(
            through, (F.col("conv") == F.col("p_conv")) & (F.col("comp") == F.col("t_comp")) & (F.col("depth") > F.col("c_depth")), "left"
        )
        below = below.select(*columns, "l_size", "c_key", "c_size", F.col("p_child").alias("child"))
        below = materialise(below, f"{folder}/below{round_}")
        is_centroid = F.col("key") == F.col("c_key")
        totals = below.where(F.col("child").isNotNull() | is_centroid).groupBy(F.col("comp").alias("t_comp")).agg(*[F.sum(s).alias(f"t_{s}") for s in sums])
        added = below.join(totals, F.col("comp") == F.col("t_comp"))
        done.append(added.where(is_centroid).select("key", *[(F.col(f"more_{s}") + F.col(f"t_{s}")).alias(s) for s in sums]))
        on_path = 2 * F.col("size") >= F.col("l_size")
        new = {"comp": F.coalesce("child", "comp").alias("comp"), "size": F.when(on_path, F.col("size") - F.col("c_size")).otherwise(F.col("size")).alias("size")}
        new |= {f"more_{s}": _plus(s, F.when(on_path, F.col(f"t_{s}")).otherwise(0)) for s in sums}
        state = added.where(~is_centroid).select(*[new.get(c, F.col(c)) for c in columns])
        round_ += 1
    small.append(state)
    rest = small[0]
    for more in small[1:]:
        rest = rest.unionByName(more)
    rest = rest.select("comp", "depth", "key", "parent", "size", *sums, *[f"more_{s}" for s in sums]).repartition("comp").sortWithinPartitions("comp", "depth")
    found = rest.mapInPandas(lambda rows: _finished(rows, sums), "key binary, " + ", ".join(f"{s} bigint" for s in sums))
    for more in done:
        found = found.unionByName(more)
    return found


def _digested(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``(e_key, ends_sha256)`` of chunks of ids that come by node, in order."""
    key, sha = None, None
    for batch in rows:
        out = []
        for k, ids in zip(batch["e_key"], batch["ids"]):
            if k != key:
                if key is not None:
                    out.append((key, sha.hexdigest()))
                key, sha = k, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids.encode())
        yield pd.DataFrame(out, columns=["e_key", "ends_sha256"])
    if key is not None:
        yield pd.DataFrame([(key, sha.hexdigest())], columns=["e_key", "ends_sha256"])


def _ends(passes: DataFrame, every: DataFrame) -> DataFrame:
    """``(e_key, ends_sha256)`` of the nodes in which conversations end, the root among them."""
    last = passes.where(F.col("depth") == F.col("length")).select(F.col("key").alias("e_key"), "conv")
    none = every.join(passes.where("depth = 1").select("conv"), "conv", "left_anti").select(F.lit(ROOT).alias("e_key"), "conv")
    chunk = F.floor(F.col("conv") / CHUNK).alias("chunk")
    ids = F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",")
    chunks = last.unionByName(none).groupBy("e_key", chunk).agg(ids.alias("ids"))
    return chunks.repartition("e_key").sortWithinPartitions("e_key", "chunk").select("e_key", "ids").mapInPandas(_digested, "e_key binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, bound: int = BOUND) -> DataFrame:
    """One row a node of the trie of rebuilt conversations (see the contract's columns in ``op12_prefix_trie``)."""
    spark = conversations.sparkSession
    folder = shared_folder(spark, "trie")
    turns, every = rebuilt_turns(conversations)
    every = materialise(every, f"{folder}/conversations")
    ordered = turns.repartition("conv").sortWithinPartitions("conv", "part", "pos").select("conv", "step", "bytes")
    passes = materialise(ordered.mapInPandas(
        _chains, "conv bigint, depth int, key binary, parent binary, top binary, bytes bigint, length int"
    ), f"{folder}/passes")
    nodes = _nodes(passes, folder)
    children = nodes.groupBy(F.col("parent").alias("of")).agg(F.count(F.lit(1)).alias("n_children"))
    owner = nodes.select(F.col("key").alias("o_key"), F.col("conv").alias("parent_conv_id"))
    nodes = nodes.join(children, F.col("key") == F.col("of"), "left").join(owner, F.col("parent") == F.col("o_key"), "left")
    n_children = F.coalesce("n_children", F.lit(0).cast("bigint"))
    nodes = materialise(nodes.drop("of", "o_key").withColumns({
        "n_children": n_children, "n_leaves": (n_children == 0).cast("bigint"), "saved_tokens": (F.col("n_convs") - 1) * F.col("bytes"),
    }), f"{folder}/nodes")
    sums = ["n_leaves", "saved_tokens"]
    totals = subtree_sums(nodes, passes, sums, folder, bound).withColumnRenamed("key", "t_key")
    totals = nodes.drop(*sums).join(totals, F.col("key") == F.col("t_key"))
    totals = materialise(totals.select("key", "conv", "depth", "parent_conv_id", "n_convs", "n_children", *sums), f"{folder}/totals")

    whole = every.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n")).where("n > 0")
    tops = totals.where("depth = 1").agg(F.count(F.lit(1)).alias("tops"), *[F.coalesce(F.sum(s), F.lit(0).cast("bigint")).alias(s) for s in sums])
    root = whole.withColumn("one", F.lit(1)).join(tops.withColumn("one", F.lit(1)), "one").select(
        F.lit(ROOT).alias("key"), "conv", F.lit(0).alias("depth"), F.lit(None).cast("bigint").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.col("tops").alias("n_children"), F.greatest("n_leaves", F.lit(1).cast("bigint")).alias("n_leaves"), "saved_tokens",
    )
    first = every.agg(F.min("conv").alias("first")).withColumn("is_top", F.lit(1))
    below = totals.withColumn("is_top", F.col("depth")).join(F.broadcast(first), "is_top", "left")
    below = below.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "first")).select(*root.columns)
    found = root.unionByName(below).join(_ends(passes, every), F.col("key") == F.col("e_key"), "left")
    number = lambda name: F.col(name).cast("bigint").alias(name)
    return found.select(
        F.col("conv").alias("conv_id"), number("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


SQL = f"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) - 1 AS pos,
         {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS x
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT c, {sql_crc32("CAST(c AS VARCHAR)")} % {SHARED} AS h FROM (SELECT DISTINCT c FROM t)
), parts AS (
  SELECT c.c, 0 AS part, pos, x FROM c JOIN t ON t.c = c.c - c.c % {GROUP} AND pos < h
  UNION ALL SELECT c.c, 1, pos, x FROM c JOIN t ON t.c = c.c AND pos >= h
), e AS (
  SELECT c, row_number() OVER w AS d, list(x) OVER w AS path, strlen(x.text) AS bytes FROM parts
  WINDOW w AS (PARTITION BY c ORDER BY part, pos ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT c, 0, [], 0 FROM c
), n AS (
  SELECT path, d, min(c) AS m, count(*) AS n_convs, any_value(bytes) AS bytes FROM e GROUP BY path, d
), em AS (
  SELECT c, e.d, m, e.d = max(e.d) OVER (PARTITION BY c) AS last FROM e JOIN n ON n.path = e.path AND n.d = e.d
), p AS (
  SELECT n.*, em.m AS parent FROM n LEFT JOIN em ON em.c = n.m AND em.d = n.d - 1
), k AS (
  SELECT parent AS m, d - 1 AS d, count(*) AS n FROM p WHERE parent IS NOT NULL GROUP BY ALL
), s AS (
  SELECT em.m, em.d, sum(CASE WHEN k.n IS NULL THEN 1 ELSE 0 END) AS leaves, sum((n.n_convs - 1) * n.bytes) AS saved
  FROM n LEFT JOIN k ON k.m = n.m AND k.d = n.d JOIN em ON em.c = n.m AND em.d <= n.d GROUP BY ALL
), ends AS (
  SELECT m, d, string_agg(c, ',' ORDER BY c) AS ids FROM em WHERE last GROUP BY ALL
)
SELECT p.m AS conv_id, CAST(p.d AS BIGINT) AS depth, p.parent AS parent_conv_id, CAST(n_convs AS BIGINT) AS n_convs,
       CAST(coalesce(k.n, 0) AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM p JOIN s ON s.m = p.m AND s.d = p.d LEFT JOIN k ON k.m = p.m AND k.d = p.d LEFT JOIN ends ON ends.m = p.m AND ends.d = p.d
"""

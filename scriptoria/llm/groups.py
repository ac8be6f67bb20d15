"""Problem 3: one group identifier for all records linked directly or indirectly.

Low-diameter decomposition: every vertex draws an exponential shift and starts a cluster at its shifted
time unless a neighbouring cluster reached it before. Clusters become super-vertices, the edges between
clusters go into the next round, and the assignments of all rounds are composed at the end. A shift is
cut at `cap`, so a round takes `cap` growth steps, which are one plan: a vertex reaches itself by an edge of
length 0, so each step is one join with the edges and one aggregation. Each round keeps a constant share of
the vertices, so chains of any length need a logarithmic number of rounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptoria.functions.text import BLANKS
from scriptoria.operators.skew import hot_keys, salted_join
from scriptoria.session import Scratch

#: Rounds after which the operator gives up; each leaves about a third of the vertices, so 60 mean a defect.
MAX_ROUNDS = 60


def _late(salt: int, beta: float, cap: int) -> Column:
    """The time at which v starts a cluster. The shift comes from a hash of vertex and round, so a recomputed task draws the same one."""
    u = (F.pmod(F.xxhash64("v", F.lit(salt)), F.lit(1 << 52)) + F.lit(1)) / F.lit(float((1 << 52) + 1))
    return F.lit(float(cap)) - F.least(-F.log(u) / F.lit(beta), F.lit(float(cap)))


def decompose(edges: DataFrame, scratch: Scratch, round_no: int, beta: float, cap: int, hot: list) -> DataFrame:
    """edges(src, dst, len), both directions and each vertex with itself -> (v, center): whose cluster reaches v first."""
    start = edges.filter("len = 0").select(F.col("src").alias("v"))
    state = start.select("v", F.struct(_late(round_no, beta, cap).alias("at"), F.col("v").alias("c")).alias("x"))
    for _ in range(cap):
        reached = salted_join(edges, state.withColumnRenamed("v", "src"), "src", hot=hot)
        state = reached.groupBy(F.col("dst").alias("v")).agg(F.min(F.struct((F.col("x.at") + F.col("len")).alias("at"), F.col("x.c").alias("c"))).alias("x"))
    return scratch.cut(state.select("v", F.col("x.c").alias("center")), f"centers{round_no}")


def _with_loops(pairs: DataFrame) -> DataFrame:
    """pairs(s, t) -> edges(src, dst, len): both directions, and every end with itself."""
    edge = lambda a, b, n: F.struct(F.col(a).alias("src"), F.col(b).alias("dst"), F.lit(n).alias("len"))
    return pairs.select(F.explode(F.array(edge("s", "t", 1), edge("t", "s", 1), edge("s", "s", 0), edge("t", "t", 0))).alias("e")).select("e.*").distinct()


def connected_groups(links: DataFrame, a: str, b: str, scratch: Scratch, beta: float = 0.25, cap: int = 9) -> DataFrame:
    """(v, root) for every end of a link; root names the group and is one of its members.

    Null ends and links of a record to itself link nothing; an empty table has no groups.
    """
    pair = links.select(F.col(a).alias("s"), F.col(b).alias("t")).filter("s is not null and t is not null and s <> t")
    edges = scratch.cut(_with_loops(pair), "edges0")
    maps: list[DataFrame] = []
    for round_no in range(1, MAX_ROUNDS + 1):
        if not edges._scratch_rows:
            break
        hot = hot_keys(edges, "src")
        center = decompose(edges, scratch, round_no, beta, cap, hot)
        maps.append(center)
        c = center.select(F.col("v").alias("src"), F.col("center").alias("c"))
        hop = salted_join(edges.filter("src < dst").select("src", "dst"), c, "src", hot=hot).select(F.col("c").alias("s"), F.col("dst").alias("src"))
        hop = salted_join(hop, c, "src", hot=hot).select("s", F.col("c").alias("t")).filter("s <> t")
        nxt = scratch.cut(_with_loops(hop), f"edges{round_no}")
        scratch.drop(edges)
        edges = nxt
    else:
        raise RuntimeError(f"edges left after {MAX_ROUNDS} rounds")
    if not maps:
        return edges.select(F.col("src").alias("v"), F.col("dst").alias("root"))
    top = maps[-1].select("v", F.col("center").alias("root"))
    for lower in reversed(maps[:-1]):
        up = top.select(F.col("v").alias("center"), F.col("root").alias("up"))
        top = salted_join(lower, up, "center", "left", hot=hot_keys(lower, "center")).select("v", F.coalesce("up", "center").alias("root"))
    return top


def duplicate_groups(rows: DataFrame, scratch: Scratch, id_col: str = "question_id", ref_col: str = "duplicate_of_question_id") -> DataFrame:
    """(question_id, group_id) of every record with a link; group_id is the group's smallest question_id.

    Ids are compared without outer blanks and letter case and shown as written. Blank, dangling and own
    references link nothing; repeated rows and repeated links change nothing.
    """
    key = lambda c: F.nullif(F.lower(F.btrim(F.col(c), F.lit(BLANKS))), F.lit(""))
    ids = rows.select(F.col(id_col).alias("question_id"), key(id_col).alias("v")).filter("v is not null").distinct()
    refs = rows.select(key(id_col).alias("a"), key(ref_col).alias("b")).filter("a is not null and b is not null and a <> b").distinct()
    links = salted_join(refs, ids.select(F.col("v").alias("b")).distinct(), "b", "left_semi")
    groups = connected_groups(links, "a", "b", scratch)
    named = scratch.cut(ids.join(groups, "v").select("question_id", "root"), "named")
    least = named.groupBy("root").agg(F.min("question_id").alias("group_id"))
    return salted_join(named, least, "root", hot=hot_keys(named, "root")).select("question_id", "group_id").distinct()

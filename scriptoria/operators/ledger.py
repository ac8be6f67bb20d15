"""Rate ledgers: leaky-bucket levels per key without a loop, and the wait until a charge fits."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def leaky_levels(charges: DataFrame, key: list[str], time_us: str, amount: str, order: list[str], limit: int, window_s: int) -> DataFrame:
    """charges with level_before and level, in millionths of an amount.

    The level falls by limit per window_s seconds, never below zero, and rises by each charge. With y the
    running sum of earlier charges less what has leaked, the level before a charge is y less the least y so
    far, if negative: two window passes over integers, so the result is exact. Null amounts charge nothing;
    rows without time keep their order but leak nothing.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    unit = F.lit(1_000_000)
    rows = charges.withColumn("_a", F.coalesce(F.col(amount), F.lit(0)).cast("bigint") * unit)
    gap = F.coalesce(F.col(time_us) - F.lag(time_us).over(w), F.lit(0))
    rows = rows.withColumn("_leak", F.floor(gap * F.lit(limit) / F.lit(window_s)).cast("bigint"))
    rows = rows.withColumn("_d", F.coalesce(F.lag("_a").over(w), F.lit(0)) - F.col("_leak"))
    rows = rows.withColumn("_y", F.sum("_d").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("level_before", F.col("_y") - F.least(F.lit(0), F.min("_y").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    return rows.withColumn("level", F.col("level_before") + F.col("_a")).drop("_a", "_leak", "_y", "_d")


def wait_needed(level: Column, need: Column, limit: float, window_s: float, margin: float = 0.9) -> Column:
    """Seconds until need fits under margin * limit; infinity if it never does."""
    cap = F.lit(limit * margin)
    return F.when(need > cap, F.lit(float("inf"))).otherwise(F.greatest(F.lit(0.0), (level + need - cap) * F.lit(window_s / limit)))


def live_cooldowns(cooldowns: DataFrame, now: float) -> DataFrame:
    """(model, seconds_left): the latest cool-down of each model that still runs."""
    return cooldowns.groupBy("model").agg(F.max("until").alias("until")).filter(F.col("until") > now).select("model", (F.col("until") - F.lit(now)).alias("seconds_left"))


def first_usable(waits: DataFrame, prefer_s: float = 20.0, most_s: float = 120.0) -> DataFrame:
    """(request, model, wait): the first model in priority whose wait is short, else the soonest; null beyond most_s."""
    best = F.min(F.when(F.col("wait") <= prefer_s, F.struct("priority", "model", "wait")))
    soonest = F.min(F.struct("wait", "priority", "model"))
    out = waits.groupBy("request").agg(best.alias("a"), soonest.alias("b"))
    wait, model = F.coalesce("a.wait", "b.wait"), F.coalesce("a.model", "b.model")
    return out.select("request", F.when(wait <= most_s, model).alias("model"), wait.alias("wait"))


def merge_intervals(rows: DataFrame, key: list[str], begin: str, end: str) -> DataFrame:
    """key + (span, begin, end): unions of overlapping or touching intervals."""
    w = Window.partitionBy(*key).orderBy(begin, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_new", F.coalesce((F.col(begin) > before).cast("int"), F.lit(1))).withColumn("span", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*key, "span").agg(F.min(begin).alias(begin), F.max(end).alias(end))


#: Dimensions of a model's limits and their windows in seconds.
WINDOWS = {"rpm": 60.0, "rpd": 86400.0, "tpm": 60.0, "tpd": 86400.0}


def budget_waits(requests: DataFrame, levels: DataFrame, cooldowns: DataFrame, models: list[tuple[str, float, float, float, float]], margin: float = 0.9) -> DataFrame:
    """(request, model, priority, wait): seconds until each model can take each request.

    requests(request, now, tokens), levels(model, dim, level, at), cooldowns(model, until); times in seconds.
    models: (name, rpm, rpd, tpm, tpd) in order of priority. A request costs one in the first two dimensions and
    its tokens in the others. The wait is the longest over the dimensions and the cool-down, infinite if it never fits.
    """
    caps = [F.struct(F.lit(m[0]).alias("model"), F.lit(k).alias("priority"), F.lit(dim).alias("dim"), F.lit(float(cap)).alias("cap"), F.lit(WINDOWS[dim]).alias("window_s")) for k, m in enumerate(models) for dim, cap in zip(WINDOWS, m[1:])]
    last = levels.groupBy("model", "dim").agg(F.max_by("level", "at").alias("level"), F.max("at").alias("at"))
    rows = requests.withColumn("m", F.explode(F.array(*caps))).select("request", "now", "tokens", "m.*").join(last, ["model", "dim"], "left")
    need = F.when(F.col("dim").isin("rpm", "rpd"), F.lit(1.0)).otherwise(F.col("tokens").cast("double"))
    cap = F.col("cap") * F.lit(margin)
    level = F.greatest(F.lit(0.0), F.coalesce("level", F.lit(0.0)) - F.greatest(F.lit(0.0), F.col("now") - F.coalesce("at", "now")) * F.col("cap") / F.col("window_s"))
    fits = F.when(need > cap, F.lit(float("inf"))).otherwise(F.greatest(F.lit(0.0), (level + need - cap) * F.col("window_s") / F.col("cap")))
    worst = rows.groupBy("request", "model").agg(F.max("priority").alias("priority"), F.max(fits).alias("wait"), F.max("now").alias("now"))
    cold = cooldowns.groupBy("model").agg(F.max("until").alias("until"))
    return worst.join(cold, "model", "left").select("request", "model", "priority", F.greatest("wait", F.coalesce("until", F.lit(0.0)) - F.col("now")).alias("wait"))


def route_calls(calls: DataFrame, models: list[tuple[str, float, float, float, float]], refuse: dict[str, int] | None = None, retry_after: float = 300.0, prefer_s: float = 20.0, most_s: float = 120.0, margin: float = 0.9) -> DataFrame:
    """calls(session, n, at, prompt, reserve, used) -> (session, n, model, started, waited): which model takes each call.

    models: (name, rpm, rpd, tpm, tpd) in order of priority. The first whose wait is at most prefer_s takes the
    call, after that wait; else the soonest, if within most_s; else none (model null). A call is charged one
    request, prompt + reserve tokens of the minute and the tokens used of the day. refuse: calls a server takes
    of a model before it answers "too many" once more; the model is then cool for retry_after seconds and the
    next takes the call. A session's calls depend on each other: one fold over each session, in order.
    """
    refuse = refuse or {}
    windows = list(WINDOWS.values())

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        level = {m[0]: [0.0] * 4 for m in models}
        at = {m[0]: [0.0] * 4 for m in models}
        cool, taken, clock, out = {}, {}, 0.0, []
        for r in pdf.sort_values("n").itertuples():
            clock = max(clock, float(r.at))
            begun, chosen = clock, None
            while chosen is None:
                waits = []
                for order, (name, *caps) in enumerate(models):
                    wait = max(0.0, cool.get(name, 0.0) - clock)
                    for k, need in enumerate((1.0, 1.0, float(r.prompt + r.reserve), float(max(r.used, r.prompt + r.reserve)))):
                        cap = caps[k] * margin
                        now = max(0.0, level[name][k] - (clock - at[name][k]) * caps[k] / windows[k])
                        wait = max(wait, float("inf") if need > cap else (now + need - cap) * windows[k] / caps[k])
                    waits.append((wait, order, name, caps))
                ready = [w for w in waits if w[0] <= prefer_s]
                wait, _, name, caps = ready[0] if ready else min(waits)
                if wait > most_s:
                    break
                clock += max(0.0, wait)
                if name in refuse and taken.get(name, 0) >= refuse[name]:
                    cool[name], taken[name] = clock + retry_after, 0
                    continue
                taken[name] = taken.get(name, 0) + 1
                for k, cost in enumerate((1.0, 1.0, float(r.prompt + r.reserve), float(r.used))):
                    level[name][k] = max(0.0, level[name][k] - (clock - at[name][k]) * caps[k] / windows[k]) + cost
                    at[name][k] = clock
                chosen = name
            out.append((r.session, int(r.n), chosen, clock if chosen else None, clock - begun))
        return pd.DataFrame(out, columns=["session", "n", "model", "started", "waited"])

    return calls.groupBy("session").applyInPandas(fold, "session string, n bigint, model string, started double, waited double")

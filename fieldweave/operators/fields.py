"""Operators on gridded, ensemble-shaped fields in long form: (member, variable, step, lat, lon, value)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import geo

DAY_STEPS = 4


def daily_fold(field: DataFrame, keys: list[str], whole: bool = True) -> DataFrame:
    """Mean, sum, least and greatest value of each key and day, and how many steps it has. A NaN makes all four null.

    A step belongs to the day that it ends, midnight to the day before. Days that lack a step, those at the edges among
    them, are dropped unless `whole` is false. Partial aggregates are combined before the one shuffle: the steps of a day
    are bits of a number, so that counting them needs no second one."""
    day = F.floor((F.col("step") - 1) / DAY_STEPS).cast("long")
    bad = F.max(F.isnan("value"))
    folds = {"mean": F.avg("value"), "sum": F.sum("value"), "least": F.min("value"), "greatest": F.max("value")}
    seen = F.bit_or(F.expr(f"shiftleft(1, CAST(pmod(step - 1, {DAY_STEPS}) AS INT))"))
    rows = field.groupBy(*keys, day.alias("day")).agg(F.bit_count(seen).cast("long").alias("steps"), *[F.when(~bad, v).alias(f"daily_{k}") for k, v in folds.items()])
    return whole_days(rows) if whole else rows


def whole_days(folded: DataFrame) -> DataFrame:
    """The days of a daily fold that have all their steps."""
    return folded.where(F.col("steps") == DAY_STEPS)


def latest_frames(field: DataFrame, keys: list[str], frames: int) -> DataFrame:
    """The last `frames` rows of each key in order of step."""
    newest = W.partitionBy(*keys).orderBy(F.desc("step"), F.desc("event_id"))
    return field.withColumn("age", F.row_number().over(newest)).where(F.col("age") <= frames)


def statistics(field: DataFrame) -> DataFrame:
    """Mean and standard deviation of each variable, NaN left out."""
    return field.where(~F.isnan("value")).groupBy("variable").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def normalize(field: DataFrame, stats: DataFrame) -> DataFrame:
    """(value - mean) / std by variable; a variable without statistics passes. There is one row of statistics a variable."""
    joined = field.join(stats, "variable", "left")
    return joined.withColumn("value", (F.col("value") - F.coalesce("mean", F.lit(0.0))) / F.coalesce("std", F.lit(1.0))).drop("mean", "std")


def fill_nan(field: DataFrame, fill: float) -> DataFrame:
    return field.withColumn("was_nan", F.isnan("value")).withColumn("value", F.nanvl("value", F.lit(fill)))


def latitude_weight(lat: Column, step: float) -> Column:
    """The share of the sphere of a cell of `step` degrees around a latitude, poles cut at 90."""
    top, bottom = F.least(F.lit(90.0), lat + step / 2), F.greatest(F.lit(-90.0), lat - step / 2)
    return (F.sin(F.radians(top)) - F.sin(F.radians(bottom))) / 2


def crps(members: DataFrame, keys: list[str], value: str, target: Column, unbiased: bool = True) -> DataFrame:
    """Ensemble CRPS: mean |x - y| less half the mean |x - x'|, the latter by ranks, so that no pairs are made."""
    order = W.partitionBy(*keys).orderBy(value)
    ranked = members.withColumn("_rank", F.row_number().over(order)).withColumn("_n", F.count(F.lit(1)).over(W.partitionBy(*keys)))
    spread = F.sum((2 * F.col("_rank") - F.col("_n") - 1) * F.col(value))
    n = F.max("_n")
    scale = n * (n - 1) if unbiased else n * n
    return ranked.groupBy(*keys).agg(n.alias("members"), (F.avg(F.abs(F.col(value) - target)) - F.when(n > 1, spread / scale).otherwise(0.0)).alias("crps"))


def packed(frame: DataFrame, ids: list[str], columns: list[str], prefix: str) -> DataFrame:
    """Columns as rows of (variable, value), names prefixed."""
    return frame.unpivot(ids, columns, "variable", "value").withColumn("variable", F.concat(F.lit(prefix), F.col("variable")))


def unpacked(rows: DataFrame, ids: list[str], names: list[str]) -> DataFrame:
    """The inverse of packed(), the names given so that no job looks for them; of repeated rows the greatest counts."""
    return rows.groupBy(*ids).pivot("variable", names).agg(F.max("value"))


def stacked(rows: DataFrame, keys: list[str], name: str, value: str) -> DataFrame:
    """All variables of a key as one vector, by name: arrays `channels` and `channel_values`. A key has one row a variable."""
    pairs = F.sort_array(F.collect_list(F.struct(name, value)))
    return rows.groupBy(*keys).agg(pairs.alias("_p")).select(*keys, F.col(f"_p.{name}").alias("channels"), F.col(f"_p.{value}").alias("channel_values"))


def unstacked(rows: DataFrame, keys: list[str], name: str, value: str) -> DataFrame:
    """The inverse of stacked()."""
    pairs = F.explode(F.arrays_zip(F.col("channels").alias(name), F.col("channel_values").alias(value)))
    return rows.select(*keys, pairs.alias("_p")).select(*keys, "_p.*")


def input_targets(field: DataFrame, keys: list[str], inputs: int, targets: int) -> DataFrame:
    """`lead` counted so that the last of `targets` steps is the newest of the key and the last input has lead 0; rows of the
    half-open input window and of the targets are kept, with their `role`."""
    newest = field.groupBy(*keys).agg(F.max("step").alias("_newest"))
    lead = F.col("step") - F.col("_newest") + targets
    out = field.join(newest, keys).withColumn("lead", lead).where((F.col("lead") > -inputs) & (F.col("lead") <= targets))
    return out.withColumn("role", F.when(F.col("lead") <= 0, "input").otherwise("target")).drop("_newest")


def to_residuals(field: DataFrame, last: DataFrame, spread: DataFrame, keys: list[str]) -> DataFrame:
    """The difference of each value from the last input (`last`, by keys), in units of `std` (by variable)."""
    out = field.join(last, keys).join(spread, "variable")
    return out.withColumn("residual", (F.col("value") - F.col("last")) / F.col("std"))


def from_residuals(rows: DataFrame) -> DataFrame:
    return rows.withColumn("restored", F.col("residual") * F.col("std") + F.col("last"))


def rollout(field: DataFrame, keys: list[str], order: str, steps: int, advance) -> DataFrame:
    """Predictions fed back as inputs: `advance(newest, one before)` gives the next value as a column, `steps` times.

    The last two frames of a key are found by partial aggregates; a key with one frame has no rollout."""
    top = field.groupBy(*keys).agg(F.max(order).alias("_a"), F.max_by("value", order).alias("_x"))
    below = field.join(top.select(*keys, "_a"), keys).where(F.col(order) < F.col("_a")).groupBy(*keys).agg(F.max_by("value", order).alias("_y"))
    state = F.struct(F.array().cast("array<double>").alias("path"), F.col("_x").alias("x"), F.col("_y").alias("y"))

    def step(s: Column, _: Column) -> Column:
        new = advance(s["x"], s["y"])
        return F.struct(F.concat(s["path"], F.array(new)).alias("path"), new.alias("x"), s["x"].alias("y"))

    path = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), state, step)["path"]
    return top.join(below, keys).select(*keys, F.posexplode(path).alias("lead", "value")).withColumn("lead", F.col("lead") + 1)


def noise_level(share: Column, most: float, least: float, rho: float) -> Column:
    """The noise at a share of the way from `most` to `least`, evenly spaced in its rho-th root."""
    a, b = most ** (1 / rho), least ** (1 / rho)
    return F.pow(share * (b - a) + a, F.lit(rho))


def churn(noise: Column, rate: float, levels: int, least: float, most: float) -> Column:
    return F.when(noise.between(least, most), min(rate / levels, 2**0.5 - 1)).otherwise(0.0)


def preconditioning(noise: Column) -> dict[str, Column]:
    """Scales of a denoiser's input, output and skip, and its loss weight, for data of unit variance."""
    both = noise * noise + 1
    return {"c_in": 1 / F.sqrt(both), "c_out": noise / F.sqrt(both), "c_skip": 1 / both, "weight": both / (noise * noise)}


def losses(rows: DataFrame, fill: float, weights: dict[str, float]) -> DataFrame:
    """Mean squared error of each variable; where the target is NaN the loss is `fill`. `weighted` uses the weights given, else 1."""
    loss = F.when(F.isnan("target"), F.lit(fill)).otherwise((F.col("prediction") - F.col("target")) ** 2)
    weight = F.lit(1.0)
    for name, w in weights.items():
        weight = F.when(F.col("variable") == name, w).otherwise(weight)
    return rows.groupBy("variable").agg(F.count(F.lit(1)).alias("n"), F.avg(loss).alias("loss")).withColumn("weighted", F.col("loss") * weight)


def total_loss(per_variable: DataFrame, weights: dict[str, float]) -> DataFrame:
    """One row: the weighted sum of the losses (variable, loss), weight 1 where none is given. A weight of a variable that
    is not there is an error."""
    there = {r["variable"] for r in per_variable.select("variable").distinct().collect()}  # names of variables
    if unknown := sorted(set(weights) - there):
        raise ValueError(f"weights of unknown variables: {unknown}")
    weight = F.coalesce(*[F.when(F.col("variable") == n, F.lit(float(w))) for n, w in weights.items()], F.lit(1.0))
    return per_variable.agg(F.sum(F.col("loss") * weight).alias("total"), F.count(F.lit(1)).alias("variables"))


def member_slice(field: DataFrame, member: str | None, first: int, after: int) -> DataFrame:
    """Members first to after - 1, or all rows if the field has no axis of members."""
    return field.where(F.col(member).between(first, after - 1)) if member in field.columns else field


def with_members(field: DataFrame, member: str, members: int) -> DataFrame:
    """Every row once for each of `members` members, numbered from 0; no two rows meet."""
    return field.withColumn(member, F.explode(F.sequence(F.lit(0), F.lit(members - 1))))


def stacked_axes(field: DataFrame, outer: str, inner: str, size: int, name: str) -> DataFrame:
    """Two numbered axes as one; unstacked_axes() is the inverse."""
    return field.withColumn(name, F.col(outer) * size + F.col(inner)).drop(outer, inner)


def unstacked_axes(field: DataFrame, name: str, size: int, outer: str, inner: str) -> DataFrame:
    return field.withColumns({outer: F.expr(f"{name} div {size}"), inner: F.col(name) % size}).drop(name)


def initial_conditions(field: DataFrame, init: Column, variables: list[str], levels: list[int] | None = None, may_lack: tuple[str, ...] = ()) -> DataFrame:
    """The two frames (init - 1 step and init) of some variables, at some levels: rows with float values.

    A value that is NaN, in a variable not named in may_lack, makes the row fail when it is read."""
    rows = field.where(F.col("variable").isin(variables) & F.col("step").isin(init - 1, init) if isinstance(init, int) else F.col("variable").isin(variables) & F.col("step").between(init - 1, init))
    if levels is not None:
        rows = rows.where(F.col("level").isin(levels) | F.col("level").isNull())
    lacks = F.isnan("value") & ~F.col("variable").isin(list(may_lack) or [""])
    told = F.raise_error(F.concat(F.lit("NaN in "), F.col("variable"))).cast("float")
    return rows.withColumn("value", F.when(lacks, told).otherwise(F.col("value").cast("float")))


def missing_inputs(field: DataFrame, inits: DataFrame, variables: list[str], levels: list[int] | None = None, statics: tuple[str, ...] = (), last: int | None = None, final: int | None = None) -> DataFrame:
    """(init, variable, level, step, reason): what the inits (steps) lack to start from, for all of them in one plan.

    Each init needs its variables (at all levels, if given) at the step before it and at its own, and the statics at any
    step. Reasons: `missing`; `beyond` for an init after `last`, the end of the record; `preliminary` for one after `final`,
    up to which the record will not change, which is a note and no fault."""
    one = inits.select("init").distinct()
    need = one.select("init", F.explode(F.array(*map(F.lit, variables or [""]))).alias("variable")).select("*", F.explode(F.array(F.col("init") - 1, F.col("init"))).alias("step"))
    need = need.withColumn("level", F.explode(F.array(*[F.lit(v) for v in levels])) if levels else F.lit(None).cast("int")) if variables else need.where("false").withColumn("level", F.lit(None).cast("int"))
    level = F.col("level").cast("int") if levels else F.lit(None).cast("int")
    there = field.where(F.col("variable").isin(variables or [""])).select(F.col("variable").alias("_v"), F.col("step").alias("_s"), level.alias("_l")).distinct()
    lacks = need.join(there, (F.col("variable") == F.col("_v")) & (F.col("step") == F.col("_s")) & F.col("level").eqNullSafe(F.col("_l")), "left_anti").withColumn("reason", F.lit("missing"))
    out = lacks.select("init", "variable", "level", "step", "reason")
    nothing = {"level": F.lit(None).cast("int"), "step": F.lit(None).cast("long")}
    if statics:
        want = one.select("init", F.explode(F.array(*map(F.lit, statics))).alias("variable"))
        known = field.where(F.col("variable").isin(list(statics))).select("variable").distinct()
        out = out.unionByName(want.join(known, "variable", "left_anti").withColumns(nothing | {"reason": F.lit("missing")}).select(*out.columns))
    for end, reason in ((last, "beyond"), (final, "preliminary")):
        if end is not None:
            out = out.unionByName(one.where(F.col("init") > end).withColumns(nothing | {"variable": F.lit(None).cast("string"), "reason": F.lit(reason)}).select(*out.columns))
    return out


def with_derived(rows: DataFrame, wanted: list[str], seconds: Column, lon: Column) -> DataFrame:
    """rows with those of the wanted variables that derive from time and place and are not there yet: year_progress and
    day_progress, each also with _sin and _cos. Columns that exist stay as they are."""
    made = {"year_progress": geo.year_progress(seconds), "day_progress": geo.day_progress(seconds, lon)}
    made |= {f"{name}_{wave}": f(made[name] * (2 * math.pi)) for name in ("year_progress", "day_progress") for wave, f in (("sin", F.sin), ("cos", F.cos))}
    return rows.withColumns({name: made[name] for name in wanted if name in made and name not in rows.columns})


def batch(inputs: DataFrame, keys: list[str], steps: int, variables: list[str]) -> DataFrame:
    """inputs (keys, variable, step, value) and behind them `steps` frames of NaN for each variable and key that has inputs."""
    newest = inputs.groupBy(*keys).agg(F.max("step").alias("_newest"))
    ahead = newest.select(*keys, "_newest", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("_k"))
    lazy = ahead.select(*keys, F.explode(F.array(*map(F.lit, variables))).alias("variable"), (F.col("_newest") + F.col("_k")).alias("step"), F.lit(float("nan")).alias("value"))
    return inputs.select(*keys, "variable", "step", "value").unionByName(lazy)


def roles(field: DataFrame, inputs: list[str], targets: list[str], forcings: list[str], first_target: Column) -> DataFrame:
    """Rows by what they are for a model, `role`: an input before the first target step; from then on a target or a forcing.

    A variable named both as target and as forcing is an error; rows that serve no purpose are dropped."""
    if both := sorted(set(targets) & set(forcings)):
        raise ValueError(f"both targets and forcings: {both}")
    is_in = lambda names: F.col("variable").isin(names) if names else F.lit(False)
    role = F.when((F.col("step") < first_target) & is_in(inputs), "input").when((F.col("step") >= first_target) & is_in(targets), "target").when((F.col("step") >= first_target) & is_in(forcings), "forcing")
    return field.withColumn("role", role).where(F.col("role").isNotNull())


def routed(variables: DataFrame, conditioning: list[str], prefix: dict[str, str]) -> DataFrame:
    """Each variable (role, variable, has_grid) and where it goes: `conditioning`, `grid` or `global`, its name prefixed by
    its role. Names that collide after that are an error when they are read."""
    name = F.concat(F.coalesce(*[F.when(F.col("role") == r, F.lit(p)) for r, p in prefix.items()], F.lit("")), F.col("variable"))
    place = F.when(F.col("variable").isin(conditioning or [""]), "conditioning").when(F.col("has_grid"), "grid").otherwise("global")
    named = variables.select("role", "variable", name.alias("name"), place.alias("place"))
    times = named.groupBy("name").agg(F.count(F.lit(1)).alias("_times"))
    return named.join(times, "name").withColumn("name", F.when(F.col("_times") > 1, F.raise_error(F.concat(F.lit("two variables named "), F.col("name"))).cast("string")).otherwise(F.col("name"))).drop("_times")


def cast_floats(df: DataFrame, to: str, only: str | None = None) -> DataFrame:
    """All columns of floating type (or of the type `only`) cast to another; the rest as they are."""
    from_types = {only} if only else {"float", "double"}
    return df.select(*[F.col(c).cast(to).alias(c) if t in from_types else F.col(c) for c, t in df.dtypes])


def noise_levels(most: float, least: float, levels: int, rho: float) -> list[float]:
    """The schedule of a sampler: `levels` noise levels from most to least, evenly spaced in their rho-th root, and 0."""
    a, b = most ** (1 / rho), least ** (1 / rho)
    return [(a + i / max(1, levels - 1) * (b - a)) ** rho for i in range(levels)] + [0.0]


def churn_rates(levels: list[float], rate: float, least: float, most: float) -> list[float]:
    """By how much noise is raised at each level but the last, 0: the rate shared out, within [least, most] only."""
    return [min(rate / (len(levels) - 1), 2**0.5 - 1) if least <= n <= most else 0.0 for n in levels[:-1]]


def bound(value: Column, use) -> Column:
    """use(value) with value evaluated once, however often it is used: plans of nested uses grow by sum, not by product."""
    return F.element_at(F.transform(F.array(value), use), 1)


def sampled(rows: DataFrame, levels: list[float], denoise, x: str | None = None, rates: list[float] | None = None, draws: Column | None = None, inflation: float = 1.0) -> DataFrame:
    """rows with `sample`: a value carried down the noise levels (the last is 0) by the second-order solver in log-noise.

    denoise(value, noise) gives the expected clean value as a column expression of two columns; it is called at each level and
    at the geometric mean of two. `draws` is an array of standard normal numbers: the first, times the highest level, starts
    the sample where no x is given; the others are used where churn (`rates`, one a level) raises the noise before a step,
    times `inflation`. The levels are folded as data, so the plan's size does not depend on how many there are."""
    if draws is None and (x is None or any(rates or [])):
        raise ValueError("without x, or with churn, draws are needed")
    rates = rates or [0.0] * (len(levels) - 1)
    steps = F.array(*[F.struct(F.lit(float(a)).alias("now"), F.lit(float(b)).alias("after"), F.lit(float(r)).alias("rate"), F.lit(i + 2).alias("draw")) for i, (a, b, r) in enumerate(zip(levels[:-1], levels[1:], rates, strict=True))])

    def down(raised: Column, now: Column, after: Column) -> Column:
        middle = F.sqrt(now * after)
        mixed = lambda old, clean, share: old * share + clean * (1 - share)
        halfway = lambda clean: bound(mixed(raised, clean, middle / now), lambda half: mixed(raised, denoise(half, middle), after / now))
        return bound(denoise(raised, now), lambda clean: F.when(after == 0, clean).otherwise(halfway(clean)))

    def level(value: Column, step: Column) -> Column:
        now = step["now"] * (1 + step["rate"])
        if draws is None:
            return down(value, now, step["after"])
        added = F.when(step["rate"] > 0, F.sqrt(now * now - step["now"] * step["now"]) * inflation * F.element_at("_draws", step["draw"])).otherwise(0.0)
        return bound(value + added, lambda raised: down(raised, now, step["after"]))

    with_draws = rows if draws is None else rows.withColumn("_draws", draws)
    start = F.col(x).cast("double") if x else F.element_at("_draws", 1) * float(levels[0])
    return with_draws.withColumn("sample", F.aggregate(steps, start, level)).drop("_draws")


def shard_index(rows: DataFrame, key: str, position: str, size: str, chunk: int, shard: int) -> DataFrame:
    """Bytes of each chunk and its first byte in its shard; a shard has shard / chunk chunks."""
    at = rows.withColumns({"shard": F.expr(f"{position} div {shard}"), "chunk": F.expr(f"{position} div {chunk}")})
    sizes = at.groupBy(key, "shard", "chunk").agg(F.sum(size).alias("nbytes"))
    before = F.sum("nbytes").over(W.partitionBy(key, "shard").orderBy("chunk"))
    return sizes.withColumn("first_byte", before - F.col("nbytes"))

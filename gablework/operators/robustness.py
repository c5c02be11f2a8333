"""How a model stands up to noise on its inputs and to edge cases."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from gablework.functions.columns import num, ratio, scalars, tidy
from gablework.functions.metrics import r2
from gablework.operators.evaluate import in_range
from gablework.roles import NOISE_LEVELS

BASE = ("area", "bedrooms", "bathrooms", "age_years", "has_garage")


def whole_number(hexes: Column) -> Column:
    """Up to 15 hex digits as DOUBLE; digits read as a whole number first cost less than as a DOUBLE."""
    return F.conv(hexes, 16, 10).cast("bigint").cast("double")


def add_digest_normals(df: DataFrame, row_id: str, salt: Column, count: int, prefix: str = "_z") -> DataFrame:
    """Standard normal draws fixed by the row id: the same on every run and engine.

    One md5 holds four 32-bit uniforms and gives four draws by Box-Muller.
    Digests, uniforms and draws are columns of their own, each computed once.
    """
    blocks = range((count + 3) // 4)
    hexes = {f"_md5_{b}": F.md5(F.concat_ws("|", row_id, salt.cast("string"), F.lit(str(b)))) for b in blocks}
    words = {
        f"_u{4 * b + i}": (whole_number(F.substring(f"_md5_{b}", 1 + 8 * i, 8)) + 1.0) / num(2**32 + 1)
        for b in blocks
        for i in range(4)
    }
    polar = {}
    for pair in range(0, 4 * len(blocks), 2):
        polar[f"_r{pair}"] = F.sqrt(F.log(f"_u{pair}") * -2.0)
        polar[f"_a{pair}"] = F.col(f"_u{pair + 1}") * num(6.283185307179586)
    draws = {}
    for i in range(count):
        pair = i - i % 2
        turn = F.cos(f"_a{pair}") if i % 2 == 0 else F.sin(f"_a{pair}")
        draws[f"{prefix}{i}"] = F.col(f"_r{pair}") * turn
    out = df.withColumns(hexes).withColumns(words).withColumns(polar).withColumns(draws)
    return out.drop(*hexes, *words, *polar)


def with_noise(
    df: DataFrame,
    columns: Sequence[str],
    levels: Sequence[float] = NOISE_LEVELS,
    row_id: str | None = None,
    seed: int = 42,
) -> DataFrame:
    """Each row once per noise level (and once clean, level 0).

    Noise is normal with ``level`` times the sample deviation of its column.
    With ``row_id`` it is derived from the id; otherwise from ``randn``.
    """
    spread = scalars(df.agg(*[F.stddev_samp(tidy(c)).alias(c) for c in columns]))
    listed = df.withColumn("noise_level", F.explode(F.array(num(0), *[num(v) for v in levels])))
    if row_id is not None:
        listed = add_digest_normals(listed, row_id, F.round(F.col("noise_level") * 1000).cast("int"), len(columns))
    else:
        listed = listed.withColumns({f"_z{i}": F.randn(seed + i) for i in range(len(columns))})
    noisy = {c: F.col(c) + F.col(f"_z{i}") * F.col("noise_level") * spread[c] for i, c in enumerate(columns)}
    return listed.withColumns(noisy).drop(*[f"_z{i}" for i in range(len(columns))])


def noise_effect(
    df: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    columns: Sequence[str] = BASE,
    levels: Sequence[float] = NOISE_LEVELS,
    row_id: str | None = None,
    actual: str = "price",
    predicted: str = "prediction",
) -> DataFrame:
    """R2 per noise level and the drop in percent of the clean R2.

    All levels are scored in one pass; ``score`` adds the prediction column.
    """
    scored = score(with_noise(df, columns, levels, row_id))
    by_level = scored.groupBy("noise_level").agg(r2(actual, predicted).alias("r2"))
    # One row per level; a window over them keeps the scoring to one pass.
    clean = F.max(F.when(F.col("noise_level") == 0, F.col("r2"))).over(Window.partitionBy())
    return (
        by_level.withColumn("base_r2", clean)
        .select(
            "noise_level",
            "r2",
            (ratio(F.col("base_r2") - F.col("r2"), F.col("base_r2")) * 100.0).alias("drop_percent"),
        )
        .where("noise_level > 0")
    )


def robustness_score(effect: DataFrame) -> DataFrame:
    """Largest drop and the score, 1 for no drop and 0 from a drop of 20 percent."""
    worst = effect.agg(F.coalesce(F.max("drop_percent"), num(0)).alias("max_drop"))
    return worst.withColumn("robustness_score", F.greatest(num(0), 1.0 - F.col("max_drop") / 20.0))


def edge_frame(df: DataFrame, rows: Sequence[tuple], district: str | None = None) -> DataFrame:
    """Edge rows as a frame with the listing columns a model needs."""
    typed = [(n, float(a), b, c, float(d), e, district) for n, a, b, c, d, e in rows]
    schema = (
        "case_name string, area double, bedrooms int, bathrooms int, age_years double, "
        "has_garage int, district string"
    )
    return df.sparkSession.createDataFrame(typed, schema)


def judge_edges(scored: DataFrame, predicted: str = "prediction") -> DataFrame:
    """Whether each edge prediction lies in the sensible price range."""
    return scored.select("case_name", predicted, in_range(predicted).alias("reasonable"))


def edge_summary(judged: DataFrame, predicted: str = "prediction") -> DataFrame:
    return judged.agg(
        F.min(predicted).alias("lowest"),
        F.max(predicted).alias("highest"),
        ratio(F.max(predicted), F.min(predicted)).alias("max_min_ratio"),
        F.count_if("reasonable").alias("reasonable_cases"),
        F.count(F.lit(1)).alias("cases"),
    )

"""Record transforms: a row that lacks what a transform needs is dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _needed(df: DataFrame, *cols: str) -> DataFrame:
    return df.na.drop(subset=list(cols))


def sft(df: DataFrame, input: str, output: str, system: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:  # noqa: A002
    """(input, output[, system]); rows without input or output are dropped."""
    cols = [F.col(input).alias("input"), F.col(output).alias("output"), *([F.col(system).alias("system")] if system else [])]
    return _needed(df, input, output).select(*keep, *cols)


def messages(user: Column, assistant: Column, system: Column | None = None) -> Column:
    """A conversation as an array of (role, content); turns without content are left out."""
    turns = [F.struct(F.lit(r).alias("role"), c.alias("content")) for r, c in (("system", system), ("user", user), ("assistant", assistant)) if c is not None]
    return F.filter(F.array(*turns), lambda x: x["content"].isNotNull())


def openai_chat(df: DataFrame, messages_col: str = "messages", keep: tuple[str, ...] = ()) -> DataFrame:
    return _needed(df, messages_col).select(*keep, F.col(messages_col).alias("messages"))


def sharegpt(df: DataFrame, messages_col: str = "messages", keep: tuple[str, ...] = ()) -> DataFrame:
    """Messages as (from, value) with the roles human, gpt and system."""
    who = lambda r: F.when(r == "user", "human").when(r == "assistant", "gpt").otherwise(r)
    return _needed(df, messages_col).select(*keep, F.transform(messages_col, lambda x: F.struct(who(x["role"]).alias("from"), x["content"].alias("value"))).alias("conversations"))


def rl_extract(df: DataFrame, params: str = "responses_create_params", keep: tuple[str, ...] = ()) -> DataFrame:
    """messages from params.input and tools from params.tools, null where there are none."""
    tools = F.col(f"{params}.tools")
    return df.where(F.col(f"{params}.input").isNotNull()).select(*keep, F.col(f"{params}.input").alias("messages"), F.when(F.size(tools) > 0, tools).alias("tools"))


def passthrough(df: DataFrame) -> DataFrame:
    return df


def select(df: DataFrame, *fields: str) -> DataFrame:
    """Only these columns; an unknown one is an error when the plan is analysed."""
    return df.select(*fields)


def rename(df: DataFrame, **new_from_old: str) -> DataFrame:
    return df.select(*(F.col(old).alias(new) for new, old in new_from_old.items()))


def preference(df: DataFrame, prompt: str, a: str, b: str, winner: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """(prompt, chosen, rejected) by the winner A or B; rows without a winner are dropped."""
    w = F.upper(F.trim(winner))
    out = df.withColumn("_w", w).where(F.col("_w").isin("A", "B"))
    first = F.col("_w") == "A"
    return out.select(*keep, F.col(prompt).alias("prompt"), F.when(first, F.col(a)).otherwise(F.col(b)).alias("chosen"), F.when(first, F.col(b)).otherwise(F.col(a)).alias("rejected"))


def union(*frames: DataFrame) -> DataFrame:
    """All rows of all frames; columns that one lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def anti(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't among the ids."""
    return df.join(ids.select(key).distinct(), key, "left_anti")

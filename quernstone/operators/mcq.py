"""Multiple-choice questions: format, answers, shuffles, distractors, filters, outliers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.functions.text import md5_int
from quernstone.operators.segments import global_rank

LETTERS = "ABCDEFGHIJ"


def letter(index: Column) -> Column:
    """A for 0, and so on."""
    return F.char(index + 65)


def index(letter_: Column) -> Column:
    return F.ascii(letter_) - 65


def formatted(question: Column, choices: Column, answer: Column | None = None) -> Column:
    """Question, lettered options and, where it is given, the answer with its text."""
    options = F.array_join(F.transform(choices, lambda c, i: F.concat(letter(i), F.lit(". "), c)), "\n")
    parts = [F.lit("Question: "), question, F.lit("\nOptions:\n"), options]
    if answer is not None:
        parts += [F.lit("\nAnswer: "), answer, F.lit(": "), F.get(choices, index(answer))]
    return F.concat(*parts)


def parsed_answer(text: Column, options: int) -> Column:
    """The letter that a model's text gives: after "answer is" or "answer:", in brackets, or alone; "-" where there is none or no such option."""
    clean = F.trim(F.regexp_replace(text, r"[*_`$]|\\boxed", ""))
    patterns = [r"(?i)answer\s*(?:is|:)?\s*[\[({]?\s*([A-J])\b", r"[\[({]\s*([A-J])\s*[\])}]", r"^\s*([A-J])\s*(?:[.):]|$)"]
    found = F.coalesce(*(F.nullif(F.upper(F.regexp_extract(clean, p, 1)), F.lit("")) for p in patterns))
    return F.when(found.isNotNull() & (index(found) < options), found).otherwise("-")


def shuffled(df: DataFrame, id_col: str, choices: str, answer: str, seed: int) -> DataFrame:
    """Choices in an order that the id, the seed and their places fix, and the answer's letter in it."""
    key = lambda i: F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string"), i.cast("string")))
    order = F.array_sort(F.transform(choices, lambda c, i: F.struct(key(i).alias("k"), i.alias("i"), c.alias("c"))))
    rows = df.withColumn("_o", order).withColumn("_a", index(F.col(answer)))
    place = F.array_position(F.transform("_o", lambda x: x["i"]), F.col("_a")) - 1
    return rows.withColumn(answer, letter(place.cast("int"))).withColumn(choices, F.transform("_o", lambda x: x["c"])).drop("_o", "_a")


def clean_distractors(df: DataFrame, choices: str, answer: str, valid: str | None = None) -> DataFrame:
    """Choices without those equal to the answer or to an earlier one, and without those that `valid` (a boolean for each) rejects; the letter follows; changed tells whether any went."""
    right = F.get(F.col(choices), index(F.col(answer)))
    keep = F.filter(F.col(choices), lambda c, i: (i == index(F.col(answer))) | ((c != right) & (F.get(valid, i) if valid else F.lit(True)) & (F.array_position(choices, c) == i + 1)))
    return df.withColumn("_r", right).withColumn("_k", keep).withColumn("changed", F.size("_k") != F.size(choices)).withColumn(answer, letter((F.array_position("_k", F.col("_r")) - 1).cast("int"))).withColumn(choices, F.col("_k")).drop("_r", "_k")


def judged(df: DataFrame, answer: str, models: list[str], easy: float = 0.8, hallucination: float = 0.5) -> DataFrame:
    """df with the share of models that gave the answer, and whether that makes the question easy or a hallucination."""
    right = sum(F.coalesce((F.col(m) == F.col(answer)).cast("int"), F.lit(0)) for m in models)
    out = df.withColumn("correct_ratio", right / F.lit(len(models)))
    return out.withColumn("is_easy", F.col("correct_ratio") > easy).withColumn("is_hallucination", F.col("correct_ratio") < hallucination)


def benchmark_rows(df: DataFrame, id_col: str, question: str, choices: str, answer: str, category: str) -> DataFrame:
    """The final projection of a benchmark, questions of four choices or more."""
    return df.where(F.size(choices) >= 4).select(F.col(id_col).alias("question_id"), F.col(question).alias("question"), F.col(choices).alias("options"), F.col(answer).alias("answer"), index(F.col(answer)).alias("answer_index"), F.col(category).alias("category"), F.lit("-").alias("cot_content"), F.lit("-").alias("src"))


def router(question: Column, answer: Column, options: Column) -> Column:
    """Which checker an answer needs: mcq, numeric or freeform."""
    return F.when(answer.rlike("^[A-J]$") & (F.size(options) >= 2), "mcq").when(answer.rlike(r"^[+-]?\d+(\.\d+)?(/\d+)?$"), "numeric").otherwise("freeform")


def outliers(df: DataFrame, id_col: str, choice_col: str, vec_col: str, is_answer: str, least_neighbours: int = 1) -> DataFrame:
    """(id_col, neighbours, outlier): two clusters of a question's choices by k-means; the answer is an outlier when its cluster has fewer other choices than that."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(choice_col)
        x = np.array(part[vec_col].tolist(), float)
        label = np.zeros(len(x), int)
        if len(x) > 1:
            far = np.unravel_index(np.argmax(((x[:, None] - x[None]) ** 2).sum(-1)), (len(x), len(x)))
            centre = x[list(far)]
            for _ in range(50):
                new = ((x[:, None] - centre[None]) ** 2).sum(-1).argmin(1)
                if (new == label).all() and _:
                    break
                label = new
                centre = np.array([x[label == c].mean(0) if (label == c).any() else centre[c] for c in (0, 1)])
        own = label[part[is_answer].to_numpy(bool)]
        n = int((label == own[0]).sum() - 1) if len(own) else 0
        return pd.DataFrame({id_col: part[id_col].iloc[:1], "neighbours": [n], "outlier": [n < least_neighbours]})

    return df.select(id_col, choice_col, vec_col, is_answer).groupBy(id_col).applyInPandas(run, f"`{id_col}` {kind}, neighbours long, outlier boolean")


def seeded_rank(id_col: str, seed: int) -> Column:
    return md5_int(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))


def with_results(df: DataFrame, results: DataFrame, id_col: str, *, valid: str | None = None) -> DataFrame:
    """df with a judge's or filter's columns, the questions only that have a result; with `valid` those only where that column is true."""
    out = df.join(results, id_col)
    return out.where(F.col(valid)).drop(valid) if valid else out


def with_distractors(df: DataFrame, distractors: DataFrame, id_col: str, column: str) -> DataFrame:
    """df with distractors joined; questions without any are dropped."""
    return df.join(distractors.select(id_col, column), id_col, "left").where(F.col(column).isNotNull())


def revalidated(df: DataFrame, results: DataFrame, id_col: str, cols: list[str]) -> DataFrame:
    """df whose `cols` are those of the results and whose former values are kept as original_*; questions without a result are dropped."""
    renamed = df.withColumnsRenamed({c: f"original_{c}" for c in cols})
    return renamed.join(results.select(id_col, *cols), id_col)


def regrouped(rows: DataFrame, id_col: str, order: str, value: str) -> DataFrame:
    """(id_col, values): the values of each question in their order, from one row a value."""
    return rows.groupBy(id_col).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value]).alias("values"))


def remapped_answer(choices: Column, right: Column) -> Column:
    """The index of the right choice among the choices, null where it is missing."""
    return F.nullif(F.array_position(choices, right) - 1, F.lit(-1))


def has_all_tags(tags: Column, wanted: list[str]) -> Column:
    """Whether a comma list of tags, blanks around them ignored, holds all of the wanted ones; a null list doesn't."""
    own = F.transform(F.split(tags, ","), lambda x: F.trim(x))
    return F.coalesce(F.size(F.array_except(F.array(*map(F.lit, wanted)), own)) == 0, F.lit(False))


def first_of_each(values: Column, key) -> Column:
    """The values without those whose key an earlier one has."""
    keys = F.transform(values, key)
    return F.filter(values, lambda x, i: F.array_position(keys, key(x)) == i + 1)


def drawn_with_replacement(df: DataFrame, order: str, draws: DataFrame, draw: str, seed: int) -> DataFrame:
    """(draw, columns of df): a row for each draw, with replacement, by a number that the draw and the seed fix. Rows are numbered in ranges; both sides
    are joined by number, so neither is held by one task."""
    ranked = global_rank(df, [order], "_k")
    n = df.count()
    at = draws.select(draw, (F.pmod(md5_int(F.concat_ws(":", F.lit(str(seed)), F.col(draw).cast("string"))), F.lit(max(n, 1))) + 1).alias("_k"))
    return at.join(ranked, "_k").drop("_k")

"""Queries of questions: joins with judges, distractors, filters and translations, tags, draws and answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernstone.functions import text as T
from quernstone.operators import mcq
from quernstone.plans.base import query
from quernstone.session import table

_H = "CAST(('0x' || substr(md5({}), 1, 15)) AS BIGINT)"


def items(spark, sf_dir):
    return table(spark, sf_dir, "eval_items")


def drawn(prefix: str, key: str = "item_id", n: int = 10):
    """A number below n that stands in for what a model or a person said of a question."""
    return F.pmod(T.md5_int(F.concat(F.lit(prefix), F.col(key).cast("string"))), F.lit(n))


def _drawn(prefix: str, key: str = "item_id", n: int = 10) -> str:
    return f"({_H.format(f"'{prefix}' || {key}")} % {n})"


@query(f"SELECT e.item_id, question, {_drawn('score')} AS score FROM eval_items e WHERE {_drawn('judged')} > 0 AND {_drawn('valid')} > 2")
def valid_judged(spark, sf_dir):
    """Questions with a judge's result that is valid; some have none."""
    judge = items(spark, sf_dir).where(drawn("judged") > 0).select("item_id", (drawn("valid") > 2).alias("is_valid_judge"), drawn("score").alias("score"))
    return mcq.with_results(items(spark, sf_dir).select("item_id", "question"), judge, "item_id", valid="is_valid_judge")


@query(f"SELECT item_id, array_to_string(choices, '|') AS options, 'no ' || answer AS distractor FROM eval_items WHERE {_drawn('distracted')} > 3")
def distractor_join(spark, sf_dir):
    given = items(spark, sf_dir).select("item_id", F.when(drawn("distracted") > 3, F.concat(F.lit("no "), "answer")).alias("distractor"))
    out = mcq.with_distractors(items(spark, sf_dir), given, "item_id", "distractor")
    return out.select("item_id", F.array_join("choices", "|").alias("options"), "distractor")


@query(f"SELECT item_id, {_drawn('easy')} / 10.0::DOUBLE AS correct_ratio, {_drawn('halluc')} > 7 AS is_hallucination FROM eval_items WHERE {_drawn('easyrun')} > 1 AND {_drawn('hallucrun')} > 1")
def filter_result_joins(spark, sf_dir):
    """Questions with the results of both filters."""
    e = items(spark, sf_dir)
    easy = e.where(drawn("easyrun") > 1).select("item_id", (drawn("easy") / F.lit(10.0)).alias("correct_ratio"))
    hallucinated = e.where(drawn("hallucrun") > 1).select("item_id", (drawn("halluc") > 7).alias("is_hallucination"))
    return mcq.with_results(mcq.with_results(e.select("item_id"), easy, "item_id"), hallucinated, "item_id")


@query(f"SELECT item_id, original_question, question, original_answer, answer, original_question <> question AS changed FROM (SELECT item_id, question AS original_question, answer AS original_answer, trim(regexp_replace(question, '[ \t\r\n]+', ' ', 'g'), ' ') AS question, upper(answer) AS answer FROM eval_items WHERE {_drawn('validated')} > 0)")
def validity_joins(spark, sf_dir):
    """Questions before and after a validation that cleans them; those that it dropped are gone."""
    e = items(spark, sf_dir)
    clean = F.trim(F.regexp_replace("question", r"[ \t\r\n]+", " "))
    done = e.where(drawn("validated") > 0).select("item_id", clean.alias("question"), F.upper("answer").alias("answer"))
    out = mcq.revalidated(e.select("item_id", "question", "answer"), done, "item_id", ["question", "answer"])
    return out.withColumn("changed", F.col("original_question") != F.col("question"))


_REV = "SELECT item_id, answer, i, choices[i] AS c, choices[ascii(answer) - 64] AS r, len(choices) AS n FROM (SELECT *, unnest(range(1, len(choices) + 1)) AS i FROM eval_items)"


@query(f"SELECT item_id, array_to_string(list(c || '*' ORDER BY md5(i || ':' || item_id)), '|') AS translated, CAST(nullif(list_position(list(c ORDER BY md5(i || ':' || item_id)), any_value(r)) - 1, -1) AS BIGINT) AS answer_index FROM ({_REV}) GROUP BY item_id HAVING list_position(list(c), any_value(r)) IS NOT NULL")
def translated_questions(spark, sf_dir):
    """Choices translated one by one in an order of their own, put together again, joined with the questions, and the answer's new index."""
    e = items(spark, sf_dir).select("item_id", "choices", F.get("choices", mcq.index(F.col("answer"))).alias("right"))
    rows = e.select("item_id", F.posexplode("choices").alias("i", "c")).select("item_id", F.md5(F.concat_ws(":", F.col("i") + 1, "item_id")).alias("o"), F.struct("c", F.concat("c", F.lit("*")).alias("t")).alias("v"))
    both = mcq.with_results(e, mcq.regrouped(rows, "item_id", "o", "v"), "item_id")
    source = F.transform("values", lambda v: v["c"])
    out = both.select("item_id", F.array_join(F.transform("values", lambda v: v["t"]), "|").alias("translated"), mcq.remapped_answer(source, F.col("right")).alias("answer_index"))
    return out.where("answer_index is not null")


@query("SELECT item_id, array_to_string(list(c ORDER BY i), '|') AS joined FROM (SELECT item_id, unnest(range(1, len(choices) + 1)) AS i, unnest(choices) AS c FROM eval_items) GROUP BY 1")
def ordered_lists(spark, sf_dir):
    rows = items(spark, sf_dir).select("item_id", F.posexplode("choices").alias("i", "c"))
    return mcq.regrouped(rows, "item_id", "i", "c").select("item_id", F.array_join("values", "|").alias("joined"))


@query("SELECT benchmark, lang, count(*) AS n, array_to_string(list(item_id ORDER BY item_id), ',') AS ids FROM eval_items GROUP BY 1, 2")
def few_shot_groups(spark, sf_dir):
    out = items(spark, sf_dir).groupBy("benchmark", "lang").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("item_id")).alias("i"))
    return out.select("benchmark", "lang", "n", F.array_join(F.transform("i", lambda x: x.cast("string")), ",").alias("ids"))


@query("SELECT item_id FROM eval_items WHERE list_has_all(list_transform(string_split(replace(benchmark, '-', ', ') || ', ' || lang, ','), lambda x: trim(x)), ['mc', 'en'])")
def tag_subset(spark, sf_dir):
    tags = F.concat(F.replace("benchmark", F.lit("-"), F.lit(", ")), F.lit(", "), "lang")
    return items(spark, sf_dir).where(mcq.has_all_tags(tags, ["mc", "en"])).select("item_id")


@query("SELECT benchmark, lang, answer, count(*) AS n FROM eval_items GROUP BY ALL")
def category_counts(spark, sf_dir):
    return items(spark, sf_dir).groupBy("benchmark", "lang", "answer").agg(F.count("*").alias("n"))


@query("SELECT item_id, array_to_string(list_filter(choices, lambda c, i: list_position(list_transform(choices, lambda x: upper(substr(x, 1, 1))), upper(substr(c, 1, 1))) = i), '|') AS options FROM eval_items")
def unique_option_names(spark, sf_dir):
    """Options without those that start like an earlier one."""
    kept = mcq.first_of_each(F.col("choices"), lambda c: F.upper(F.substring(c, 1, 1)))
    return items(spark, sf_dir).select("item_id", F.array_join(kept, "|").alias("options"))


@query("SELECT d AS draw, item_id, question FROM (SELECT unnest(range(0, 500)) AS d) JOIN (SELECT item_id, question, row_number() OVER (ORDER BY item_id) - 1 AS k FROM eval_items) ON k = " + _H.format("'42:' || d") + " % (SELECT count(*) FROM eval_items)")
def samples_with_replacement(spark, sf_dir):
    draws = spark.range(500).select(F.col("id").alias("draw"))
    return mcq.drawn_with_replacement(items(spark, sf_dir).select("item_id", "question"), "item_id", draws, "draw", 42)


_CASES = "SELECT record_id AS id, judge AS raw FROM sdg_preference UNION ALL SELECT item_id + 100000000, CAST(to_json(choices) AS VARCHAR) FROM eval_items UNION ALL SELECT event_id + 200000000, props FROM events UNION ALL SELECT event_id + 300000000, CAST(value AS VARCHAR) FROM events"


@query(f"SELECT id, CASE WHEN json_valid(raw) THEN CASE json_type(raw) WHEN 'ARRAY' THEN json_extract_string(raw, '$[0]') WHEN 'OBJECT' THEN json_extract_string(raw, '$.\"' || json_keys(raw)[1] || '\"') ELSE json_extract_string(raw, '$') END ELSE raw END AS answer FROM ({_CASES})")
def json_answers(spark, sf_dir):
    """Answers in lists, objects, scalars and what is no JSON."""
    events = table(spark, sf_dir, "events")
    rows = table(spark, sf_dir, "sdg_preference").select(F.col("record_id").alias("id"), F.col("judge").alias("raw"))
    rows = rows.unionByName(items(spark, sf_dir).select((F.col("item_id") + 100_000_000).alias("id"), F.to_json("choices").alias("raw")))
    rows = rows.unionByName(events.select((F.col("event_id") + 200_000_000).alias("id"), F.col("props").alias("raw")))
    rows = rows.unionByName(events.select((F.col("event_id") + 300_000_000).alias("id"), F.col("value").cast("string").alias("raw")))
    return rows.select("id", T.json_answer(F.col("raw")).alias("answer"))


@query("SELECT item_id, CAST(to_json(choices) AS VARCHAR) AS packed FROM eval_items")
def stringified(spark, sf_dir):
    return items(spark, sf_dir).select("item_id", F.to_json("choices").alias("packed"))


@query("SELECT record_id, regexp_replace('Q' || c.seed_id || ': ' || question || coalesce(chr(10) || channel || chr(10), ''), '\\n+$', '') AS restored FROM (SELECT DISTINCT record_id, seed_id, channel FROM sdg_chat) c JOIN eval_items ON item_id = seed_id + 150 WHERE question IS NOT NULL")
def placeholder_lookup(spark, sf_dir):
    """Records that name a row of another table: the row's question between the record's own prefix and suffix; rows out of range are dropped."""
    refs = table(spark, sf_dir, "sdg_chat").select("record_id", "seed_id", "channel").distinct().withColumn("item_id", F.col("seed_id") + 150)
    suffix = F.concat(F.lit("\n"), "channel", F.lit("\n"))
    text = T.restored(F.concat(F.lit("Q"), "seed_id", F.lit(": ")), F.col("question"), suffix)
    return refs.join(items(spark, sf_dir).select("item_id", "question"), "item_id").select("record_id", text.alias("restored")).where("restored is not null")


@query(f"SELECT item_id, CAST(i - 1 AS BIGINT) AS place, choices[i] AS choice FROM (SELECT item_id, choices, unnest(range(1, len(choices) + 1)) AS i FROM eval_items) WHERE {_drawn('overall', "item_id || '-' || (i - 1)")} >= 7")
def quality_threshold(spark, sf_dir):
    """Pairs whose overall score is 7 or more."""
    rows = items(spark, sf_dir).select("item_id", F.posexplode("choices").alias("place", "choice"))
    score = F.pmod(T.md5_int(F.concat(F.lit("overall"), F.concat_ws("-", "item_id", "place"))), F.lit(10))
    return rows.where(score >= 7).select("item_id", F.col("place").cast("long").alias("place"), "choice")

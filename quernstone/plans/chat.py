"""Queries over chats and preference records: transforms, templates, masks, tokens."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernstone.functions import text as T
from quernstone.operators import chat, tokenization, transforms
from quernstone.plans.base import query
from quernstone.session import table

_ONE = "(SELECT DISTINCT ON (record_id) * FROM sdg_chat ORDER BY record_id, loaded_at)"


def chats(spark, sf_dir):
    """The chats, each record once, the first that was loaded."""
    c = table(spark, sf_dir, "sdg_chat")
    keep = [x for x in c.columns if x != "record_id"]
    return c.groupBy("record_id").agg(F.min_by(F.struct(*keep), F.struct(F.coalesce("loaded_at", F.lit("9999-01-01").cast("timestamp_ntz")))).alias("r")).select("record_id", "r.*")


def conversations(spark, sf_dir):
    c = chats(spark, sf_dir)
    return c.select("record_id", transforms.messages(F.col("user_query"), F.col("assistant_response"), F.concat(F.lit("You work for the "), F.coalesce("segment", F.lit("any")), F.lit(" desk."))).alias("messages"))


@query("SELECT DISTINCT record_id, user_query AS input, assistant_response AS output, segment AS system FROM sdg_chat WHERE user_query IS NOT NULL AND assistant_response IS NOT NULL")
def sft_records(spark, sf_dir):
    return transforms.sft(table(spark, sf_dir, "sdg_chat"), "user_query", "assistant_response", "segment", keep=("record_id",)).distinct()


_MSGS = "'<|im_start|>system' || chr(10) || 'You work for the ' || coalesce(segment, 'any') || ' desk.<|im_end|>' || chr(10) || CASE WHEN user_query IS NULL THEN '' ELSE '<|im_start|>user' || chr(10) || user_query || '<|im_end|>' || chr(10) END || CASE WHEN assistant_response IS NULL THEN '' ELSE '<|im_start|>assistant' || chr(10) || assistant_response || '<|im_end|>' || chr(10) END"


@query(f"SELECT DISTINCT record_id, md5({_MSGS}) AS digest FROM sdg_chat")
def chatml_render(spark, sf_dir):
    return conversations(spark, sf_dir).select("record_id", F.md5(chat.chatml(F.col("messages"))).alias("digest"))


@query("SELECT DISTINCT record_id, 1 + CAST(user_query IS NOT NULL AS INTEGER) + CAST(assistant_response IS NOT NULL AS INTEGER) AS turns, 'system' || CASE WHEN user_query IS NULL THEN '' ELSE ',human' END || CASE WHEN assistant_response IS NULL THEN '' ELSE ',gpt' END AS speakers FROM sdg_chat")
def sharegpt_records(spark, sf_dir):
    out = transforms.sharegpt(conversations(spark, sf_dir), keep=("record_id",))
    return out.select("record_id", F.size("conversations").alias("turns"), F.array_join(F.transform("conversations", lambda x: x["from"]), ",").alias("speakers"))


@query("SELECT DISTINCT record_id FROM sdg_chat WHERE NOT (coalesce(user_query, '') LIKE '%<tool_call>%' OR coalesce(assistant_response, '') LIKE '%<tool_call>%') OR coalesce(user_query, '') LIKE '%# Tools%' OR coalesce(assistant_response, '') LIKE '%# Tools%'")
def valid_conversations(spark, sf_dir):
    return conversations(spark, sf_dir).where(chat.is_valid(F.col("messages"))).select("record_id")


@query(
    r"""SELECT DISTINCT record_id, prompt, CASE WHEN w = 'A' THEN response_a ELSE response_b END AS chosen, CASE WHEN w = 'A' THEN response_b ELSE response_a END AS rejected
FROM (SELECT *, upper(trim(regexp_extract(regexp_extract(judge, '(\{(?s:.)*\})', 1), '"winner"\s*:\s*"([^"]*)"', 1))) AS w FROM sdg_preference) WHERE w IN ('A', 'B')"""
)
def dpo_preferences(spark, sf_dir):
    winner = F.get_json_object(T.json_in_fences(F.col("judge")), "$.winner")
    return transforms.preference(table(spark, sf_dir, "sdg_preference"), "prompt", "response_a", "response_b", winner, keep=("record_id",)).distinct()


_N = "len(list_filter(string_split_regex({}, '[ \t\r\n]+'), lambda x: x <> ''))"


@query(f"SELECT DISTINCT record_id, coalesce({_N.format('user_query')}, 0) + coalesce({_N.format('assistant_response')}, 0) AS tokens, coalesce({_N.format('assistant_response')}, 0) AS trained FROM sdg_chat")
def loss_masks(spark, sf_dir):
    c = conversations(spark, sf_dir).select("record_id", F.filter("messages", lambda m: m["role"] != "system").alias("messages"))
    chunks = F.transform("messages", lambda m: F.struct(m["role"].alias("role"), T.tokens(m["content"]).alias("tokens")))
    mask = tokenization.loss_mask(chunks)
    return c.select("record_id", mask.alias("mask")).select("record_id", F.size("mask").cast("long").alias("tokens"), F.aggregate("mask", F.lit(0), lambda a, x: a + x).cast("long").alias("trained"))


@query(
    f"""SELECT reason, count(*) AS rows FROM (SELECT DISTINCT record_id, CASE WHEN user_query IS NULL THEN 'no query' WHEN assistant_response IS NULL THEN 'no answer' WHEN {_N.format("assistant_response")} < 3 THEN 'short answer' WHEN assistant_response LIKE '%```%' THEN 'code' ELSE 'kept' END AS reason FROM sdg_chat) GROUP BY 1"""
)
def drop_accounting(spark, sf_dir):
    a = F.col("assistant_response")
    reason = F.when(F.col("user_query").isNull(), "no query").when(a.isNull(), "no answer").when(T.n_tokens(a) < 3, "short answer").when(a.contains("```"), "code")
    return tokenization.accounting(chats(spark, sf_dir).withColumn("reason", reason), "reason")


@query()
def role_chunks(spark, sf_dir):
    """Chunks of full conversations by the template, with thoughts."""
    c = conversations(spark, sf_dir).select("record_id", F.to_json(F.struct("messages")).alias("j"))
    return chat.render(c, "record_id", "j").select("record_id", "seq", "pos", "role", F.md5("chunk").alias("digest"))


@query("SELECT DISTINCT record_id, CASE WHEN assistant_response IS NOT NULL THEN least(strlen(assistant_response) + 1, 2048) END AS n, coalesce(strlen(assistant_response) + 1 > 2048, false) AS truncated, false AS failed FROM sdg_chat")
def byte_tokens(spark, sf_dir):
    out = tokenization.tokenize(chats(spark, sf_dir).select("record_id", "assistant_response"), "record_id", "assistant_response", "bytes", most_tokens=2048, eos=256)
    return out.select("record_id", F.size("ids").alias("n"), "truncated", "failed")


@query("SELECT count(*) AS sequences, sum(strlen(assistant_response) + 1) AS tokens, min(strlen(assistant_response) + 1) AS shortest, max(strlen(assistant_response) + 1) AS longest FROM (SELECT DISTINCT record_id, assistant_response FROM sdg_chat) WHERE assistant_response IS NOT NULL")
def token_stats(spark, sf_dir):
    out = tokenization.tokenize(chats(spark, sf_dir).select("record_id", "assistant_response"), "record_id", "assistant_response", "bytes", eos=256)
    s = tokenization.token_stats(out)
    return s.select("sequences", "tokens", F.col("shortest").cast("long").alias("shortest"), F.col("longest").cast("long").alias("longest"))


@query("SELECT coalesce(lower(inquiry_type), 'none') AS inquiry_type, count(*) AS n, count(*) FILTER (WHERE user_query IS NULL) AS missing_question, count(*) FILTER (WHERE assistant_response IS NULL) AS missing_answer FROM (SELECT DISTINCT record_id, inquiry_type, user_query, assistant_response FROM sdg_chat) GROUP BY 1")
def reason_counts(spark, sf_dir):
    c = chats(spark, sf_dir)
    return c.groupBy(F.coalesce(F.lower("inquiry_type"), F.lit("none")).alias("inquiry_type")).agg(F.count("*").alias("n"), F.count_if(F.col("user_query").isNull()).alias("missing_question"), F.count_if(F.col("assistant_response").isNull()).alias("missing_answer"))


@query("SELECT DISTINCT c.record_id, s.product, s.issue FROM sdg_chat c JOIN sdg_seeds s USING (seed_id)")
def seed_lookup(spark, sf_dir):
    return chats(spark, sf_dir).select("record_id", "seed_id").join(table(spark, sf_dir, "sdg_seeds"), "seed_id").select("record_id", "product", "issue")


@query("SELECT record_id FROM (SELECT DISTINCT record_id, seed_id FROM sdg_chat) c WHERE seed_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM sdg_seeds s WHERE s.seed_id = c.seed_id)")
def dangling_seeds(spark, sf_dir):
    return chats(spark, sf_dir).where("seed_id is not null").select("record_id", "seed_id").join(table(spark, sf_dir, "sdg_seeds"), "seed_id", "left_anti").select("record_id")


@query("SELECT DISTINCT record_id, 'Answer as a ' || coalesce(segment, 'guest') || ': ' || coalesce(user_query, '') AS filled, coalesce(nullif(trim(user_query), ''), nullif(trim(inquiry_type), ''), '-') AS first_field FROM sdg_chat")
def template_fill(spark, sf_dir):
    t = F.concat(F.lit("Answer as a "), F.coalesce("segment", F.lit("guest")), F.lit(": {question}"))
    return chats(spark, sf_dir).select("record_id", T.fill_question(t, F.coalesce("user_query", F.lit(""))).alias("filled"), F.coalesce(T.first_filled(F.col("user_query"), F.col("inquiry_type")), F.lit("-")).alias("first_field"))


@query(f"SELECT DISTINCT record_id, md5(left({_MSGS}, greatest(instr({_MSGS}, '<|im_start|>user' || chr(10)) - 1, 0))) AS system, md5(substr({_MSGS}, instr({_MSGS}, '<|im_start|>user' || chr(10)))) AS rest FROM sdg_chat WHERE user_query IS NOT NULL")
def system_user_split(spark, sf_dir):
    """The rendering cut where the first user's turn begins."""
    c = conversations(spark, sf_dir).select("record_id", chat.system_and_user(chat.chatml(F.col("messages"))).alias("s"))
    return c.where("s.user is not null").select("record_id", F.md5("s.system").alias("system"), F.md5("s.user").alias("rest"))


_SAYS = "'<|im_start|>{}' || chr(10) || {} || '<|im_end|>' || chr(10)"
_TOOL_TEXT = " || ".join([
    _SAYS.format("system", "'# Tools' || chr(10) || chr(10) || '<tools>' || chr(10) || '{\"name\": \"lookup\"}' || chr(10) || '</tools>'"),
    _SAYS.format("user", "coalesce(user_query, '')"),
    _SAYS.format("assistant", "'<think></think>' || chr(10) || '<tool_call>' || chr(10) || '<function=lookup>' || chr(10) || '<parameter=seed>' || chr(10) || seed_id || chr(10) || '</parameter>' || chr(10) || '</function>' || chr(10) || '</tool_call>'"),
    _SAYS.format("user", "'<tool_response>' || chr(10) || product || chr(10) || '</tool_response>' || chr(10)"),
    _SAYS.format("assistant", "'<think>' || chr(10) || 'It is ' || product || '.' || chr(10) || '</think>' || chr(10) || coalesce(assistant_response, '')"),
])


@query(f"SELECT DISTINCT record_id, 5 AS chunks, md5({_TOOL_TEXT}) AS digest FROM sdg_chat JOIN sdg_seeds USING (seed_id)")
def tool_conversations(spark, sf_dir):
    """Conversations with tools, a call whose arguments are JSON text, its answer, and thoughts, rendered by the template."""
    c = chats(spark, sf_dir).select("record_id", "seed_id", "user_query", "assistant_response").join(table(spark, sf_dir, "sdg_seeds").select("seed_id", "product"), "seed_id")
    says = lambda role, content, thought=None, call=None: F.struct(F.lit(role).alias("role"), content.alias("content"), (F.lit(None).cast("string") if thought is None else thought).alias("reasoning_content"), (F.lit(None).cast("array<struct<function:struct<name:string,arguments:string>>>") if call is None else call).alias("tool_calls"))
    call = F.array(F.struct(F.struct(F.lit("lookup").alias("name"), F.to_json(F.struct(F.col("seed_id").alias("seed"))).alias("arguments")).alias("function")))
    turns = F.array(says("user", F.col("user_query")), says("assistant", F.lit(""), call=call), says("tool", F.col("product")), says("assistant", F.col("assistant_response"), F.concat(F.lit("It is "), "product", F.lit("."))))
    rows = c.select("record_id", F.to_json(F.struct(turns.alias("messages"), F.array(F.struct(F.lit("lookup").alias("name"))).alias("tools"))).alias("j"))
    out = chat.render(rows, "record_id", "j").groupBy("record_id").agg(F.count("*").cast("int").alias("chunks"), F.array_sort(F.collect_list(F.struct("seq", "pos", "chunk"))).alias("c"))
    return out.select("record_id", "chunks", F.md5(F.array_join(F.transform("c", lambda x: x["chunk"]), "")).alias("digest"))


@query("SELECT record_id, valid FROM (SELECT DISTINCT record_id, NOT (record_id % 3 = 0) OR record_id % 2 = 0 AS valid FROM sdg_chat)")
def tool_validity(spark, sf_dir):
    """Whether conversations are valid of which a third calls tools and half of all list some."""
    c = table(spark, sf_dir, "sdg_chat").select("record_id").distinct()
    says = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    turns = F.array(says("system", F.when(F.col("record_id") % 2 == 0, "# Tools")), says("assistant", F.when(F.col("record_id") % 3 == 0, "<tool_call>x</tool_call>")))
    return c.select("record_id", chat.is_valid(turns).alias("valid"))


@query("SELECT DISTINCT c.record_id, c.seed_id + 200 AS seed FROM sdg_chat c WHERE seed_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM sdg_seeds s WHERE s.seed_id = c.seed_id + 200)")
def dangling_shifted_seeds(spark, sf_dir):
    """References that point 200 rows further, of which many are out of range."""
    c = table(spark, sf_dir, "sdg_chat").where("seed_id is not null").select("record_id", (F.col("seed_id") + 200).alias("seed")).distinct()
    return transforms.anti(c, table(spark, sf_dir, "sdg_seeds").withColumnRenamed("seed_id", "seed"), "seed").select("record_id", "seed")

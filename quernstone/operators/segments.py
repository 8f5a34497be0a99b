"""Segments, windows and chunks of texts, and running sums over rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.functions.text import n_tokens
from quernstone.operators.ranges import rank_within, restarting_blocks, running_sum


def split_lines(df: DataFrame, id_col: str, text_col: str, separator: str = "\n") -> DataFrame:
    """(id_col, segment_id from 0, segment): the text cut at a separator; a null text has none."""
    return df.select(id_col, F.posexplode(F.split(text_col, separator)).alias("segment_id", "segment"))


def join_segments(segments: DataFrame, id_col: str, order_col: str, text_col: str, most_tokens: int, separator: str = "\n") -> DataFrame:
    """(id_col, block from 0, text, segments, tokens): neighbouring segments joined while they hold most_tokens at most.

    Segments that hold more by themselves are left out first. Only sizes are folded in order, as a stream; a task holds the segments of one block.
    """
    sized = segments.select(id_col, order_col, F.col(text_col).alias("_t"), n_tokens(F.col(text_col)).cast("long").alias("_n")).where(F.col("_n") <= most_tokens)
    placed = restarting_blocks(sized, [id_col], order_col, "_n", most_tokens, "block")
    out = placed.groupBy(id_col, "block").agg(F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"), F.col("_t").alias("t")))).alias("_s"), F.count("*").alias("segments"), F.sum("_n").alias("tokens"))
    return out.select(id_col, "block", F.array_join(F.transform("_s", lambda x: x["t"]), separator).alias("text"), "segments", "tokens")


def windows(df: DataFrame, id_col: str, text_col: str, window: int, hop: int) -> DataFrame:
    """(id_col, k, start, stop, window) of character windows that start every `hop` characters.

    A text shorter than a window is one. Windows that would reach over the end are none of their own: what they would add goes to the last whole window.
    With hop < window several of them end in the same tail, and it is added once.
    """
    n = F.length(text_col)
    whole = F.when(n < window, 1).otherwise(F.expr(f"(length(`{text_col}`) - {window}) div {hop}").cast("int") + 1)
    rows = df.select(id_col, F.col(text_col).alias("_t"), n.alias("_n"), whole.alias("_w")).select(id_col, "_t", "_n", "_w", F.explode(F.sequence(F.lit(0), F.col("_w") - 1)).alias("k"))
    start = F.col("k") * hop
    last = (F.col("k") == F.col("_w") - 1) & (F.col("_n") >= window)
    stop = F.when(last, F.col("_n")).otherwise(start + window)
    return rows.select(id_col, "k", start.alias("start"), stop.alias("stop"), F.substring("_t", start + 1, stop - start).alias("window"))


def random_chunk(df: DataFrame, id_col: str, text_col: str, window: int, seed: int) -> DataFrame:
    """(id_col, chunk): `window` characters from a place that the id and the seed fix."""
    from quernstone.functions.text import unit

    start = F.floor(unit(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(seed))) * (F.greatest(F.length(text_col) - window, F.lit(0)) + 1)).cast("int")
    return df.select(id_col, F.substring(F.col(text_col), start + 1, F.lit(window)).alias("chunk"))


def sentence_chunks(df: DataFrame, id_col: str, text_col: str, sentences: int) -> DataFrame:
    """(id_col, chunk, chunk_text): runs of so many sentences."""
    parts = F.filter(F.split(F.replace(F.col(text_col), F.lit("\n"), F.lit(" ")), "[.!?] +"), lambda x: x != "")
    rows = df.select(id_col, parts.alias("_p")).where(F.size("_p") > 0)
    rows = rows.select(id_col, "_p", F.explode(F.expr(f"sequence(0, cast((size(_p) - 1) div {sentences} as int))")).alias("chunk"))
    return rows.select(id_col, "chunk", F.array_join(F.slice("_p", F.col("chunk") * sentences + 1, F.lit(sentences)), " ").alias("chunk_text"))


def page_windows(pages: DataFrame, doc_col: str, page_col: str, least: int = 2) -> DataFrame:
    """(doc_col, window, pages): whole windows of 2 to 8 pages by the document's number of pages; a short tail is left out."""
    n = F.col("_n")
    size = F.when((n > 60), 8).when((n > 50) & (n < 60), 7).when((n > 40) & (n < 50), 6).when((n > 30) & (n < 40), 5).when((n > 20) & (n < 30), 4).otherwise(2)
    rows = rank_within(pages.select(doc_col, page_col), [doc_col], [page_col], "_i", "_n").withColumn("_size", size)
    rows = rows.groupBy(doc_col, F.floor((F.col("_i") - 1) / F.col("_size")).alias("window")).agg(F.sort_array(F.collect_list(page_col)).alias("pages"), F.first("_size").alias("_size"))
    return rows.where((F.size("pages") == F.col("_size")) & (F.size("pages") >= least)).select(doc_col, "window", "pages")


def bundles(df: DataFrame, id_col: str, size: int, how: str = "sequential", group_col: str | None = None) -> DataFrame:
    """(bundle, id_col): documents in bundles: neighbours by id, or one of each group in turn (interleaved)."""
    if how == "interleaved" and group_col:
        ranked = rank_within(df.select(id_col, group_col), [group_col], [id_col], "_r")
        ranked = global_rank(ranked, ["_r", id_col], "_k")
    else:
        ranked = global_rank(df.select(id_col), [id_col], "_k")
    return ranked.select(F.expr(f"(_k - 1) div {size}").alias("bundle"), id_col)


def global_rank(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """df with the rank of each row from 1 in a total order, without bringing the rows to one task."""
    return rank_within(df, [], order, out)


def exclusive_sum(df: DataFrame, order: str, value: str, out: str) -> DataFrame:
    """df with the sum of the values of all rows before each in a total order."""
    return running_sum(df, [], [order], value, out).withColumn(out, F.col(out) - F.col(value))


def stitched(df: DataFrame, file: str, order: str, size: str, out: str) -> DataFrame:
    """df with each row's offset in all files put together by name: that within its file plus the sizes of the files before it."""
    inner = running_sum(df, [file], [order], size, out).withColumn(out, F.col(out) - F.col(size))
    files = df.groupBy(file).agg(F.sum(size).alias("_s"))
    bases = running_sum(files, [], [file], "_s", "_base").select(F.col(file).alias("_f"), (F.col("_base") - F.col("_s")).alias("_base"))
    return inner.join(bases, F.col(file).eqNullSafe(F.col("_f"))).withColumn(out, F.col(out) + F.col("_base")).select(*df.columns, out)


def until_budget(df: DataFrame, order: str, value: str, budget: int) -> DataFrame:
    """The leading rows whose predecessors sum to less than the budget; null values count 0."""
    out = exclusive_sum(df.withColumn("_v", F.coalesce(value, F.lit(0))), order, "_v", "_before_all")
    return out.where(F.col("_before_all") < budget).drop("_v", "_before_all")


def elements(text: Column) -> Column:
    """Page elements <x_..><y_..>text<x_..><y_..><class_..> of a parser's output as (x1, y1, x2, y2, text, class)."""
    pattern = r"<x_([\d.]+)><y_([\d.]+)>([\s\S]*?)<x_([\d.]+)><y_([\d.]+)><class_([^>]+)>"
    part = lambda i: F.regexp_extract_all(text, F.lit(pattern), i)
    zipped = F.arrays_zip(*(part(i).alias(n) for i, n in ((1, "x1"), (2, "y1"), (4, "x2"), (5, "y2"), (3, "text"), (6, "class"))))
    return F.transform(zipped, lambda e: F.struct(e["x1"].cast("double").alias("x1"), e["y1"].cast("double").alias("y1"), e["x2"].cast("double").alias("x2"), e["y2"].cast("double").alias("y2"), e["text"].alias("text"), e["class"].alias("class")))

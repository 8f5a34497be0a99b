"""Text functions as column expressions; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_int(c: Column) -> Column:
    """A number below 2 to the 60th from the first 15 hex digits of the MD5 of a string."""
    return F.conv(F.substring(F.md5(c), 1, 15), 16, 10).cast("bigint")


def unit(c: Column) -> Column:
    """A number in [0, 1) from the MD5 of a string."""
    return md5_int(c) / F.lit(float(1 << 60))


def tokens(c: Column) -> Column:
    """Pieces between runs of blanks, tabs and line ends; an empty text has none."""
    return F.filter(F.split(c, r"[ \t\r\n]+"), lambda x: x != "")


def n_tokens(c: Column) -> Column:
    return F.size(tokens(c))


def language_code(c: Column) -> Column:
    """The code in a score string such as "[0.95, 'EN']", in upper case; null where there is none."""
    return F.nullif(F.upper(F.regexp_extract(c, r"'([A-Za-z]+)'", 1)), F.lit(""))


def language_score(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"\[\s*([0-9.]+)", 1), F.lit("")).try_cast("double")


def used_in(c: Column, name: str) -> Column:
    """Whether a comma list holds the name; a null list doesn't."""
    return F.coalesce(F.array_contains(F.transform(F.split(c, ","), lambda x: F.trim(x)), name), F.lit(False))


def without_markdown(c: Column) -> Column:
    """Markdown marks taken off: code fences, headings, emphasis, links, images, quotes and list marks. Lines end with \\n alone; \\r is a character of the line."""
    for pattern, new in ((r"```[a-z]*\n?", ""), (r"(?dm)^#{1,6} +", ""), (r"!\[([^\]]*)\]\([^)]*\)", "$1"), (r"\[([^\]]*)\]\([^)]*\)", "$1"), (r"\*\*([^*\n]+)\*\*", "$1"), (r"\*([^*\n]+)\*", "$1"), (r"`([^`\n]*)`", "$1"), (r"(?dm)^> ?", ""), (r"(?dm)^[-*+] +", "")):
        c = F.regexp_replace(c, pattern, new)
    return c


def slice_after(c: Column, left: str) -> Column:
    """What follows the first `left`, stripped; the whole text, stripped, where it is missing."""
    at = F.instr(c, left)
    return F.trim(F.when(at > 0, F.substring(c, at + len(left), F.length(c))).otherwise(c))


def without_quotes(c: Column) -> Column:
    """A pair of quotes around the whole text is taken off."""
    return F.regexp_replace(c, r'^"([\s\S]*)"$', "$1")


def without_lines(c: Column, lines: list[str]) -> Column:
    """Lines equal to one of `lines` are taken out."""
    return F.array_join(F.filter(F.split(c, "\n"), lambda x: ~x.isin(lines)), "\n")


def json_in_fences(c: Column) -> Column:
    """The JSON object in a text of a model: without code fences, from the first { to the last }; null where there is none."""
    return F.nullif(F.regexp_extract(c, r"(\{[\s\S]*\})", 1), F.lit(""))


def strip_wrapper(c: Column) -> Column:
    """Of three or more paragraphs the first and the last are dropped."""
    parts = F.split(c, "\n\n")
    return F.when(F.size(parts) >= 3, F.array_join(F.slice(parts, F.lit(2), F.size(parts) - 2), "\n\n")).otherwise(c)


def fill_question(template: Column, question: Column) -> Column:
    """The template with {question} replaced; the question alone where the template has no such field."""
    return F.when(template.contains("{question}"), F.replace(template, F.lit("{question}"), question)).otherwise(question)


def first_filled(*cols: Column) -> Column:
    """The first column that is neither null nor blank."""
    return F.coalesce(*(F.nullif(F.trim(c), F.lit("")) for c in cols))


def size_in_bytes(c: Column) -> Column:
    """Sizes such as 256MB or 1.5G, by 1024."""
    n, unit_ = F.regexp_extract(c, r"^\s*([0-9.]+)", 1).try_cast("double"), F.upper(F.regexp_extract(c, r"([KMGTkmgt])?[iI]?[bB]?\s*$", 1))
    factor = F.when(unit_ == "K", 1 << 10).when(unit_ == "M", 1 << 20).when(unit_ == "G", 1 << 30).when(unit_ == "T", 1 << 40).otherwise(1)
    return (n * factor).cast("bigint")


def count_text(c: Column) -> Column:
    """Counts such as 1.5M, by 1000."""
    return F.when(c >= 1e9, F.concat(F.format_string("%.1f", c / 1e9), F.lit("B"))).when(c >= 1e6, F.concat(F.format_string("%.1f", c / 1e6), F.lit("M"))).when(c >= 1e3, F.concat(F.format_string("%.1f", c / 1e3), F.lit("K"))).otherwise(c.cast("string"))


def snake_case(c: Column) -> Column:
    """CamelCase to snake_case, without the suffix Stage and with single underscores."""
    c = F.regexp_replace(c, "Stage$", "")
    c = F.regexp_replace(F.regexp_replace(c, "([a-z0-9])([A-Z])", "$1_$2"), "[^A-Za-z0-9]+", "_")
    return F.regexp_replace(F.lower(c), "^_+|_+$", "")


def is_number(c: Column) -> Column:
    """Integers, decimals and fractions."""
    return c.rlike(r"^[+-]?\d+(\.\d+)?(/\d+)?$")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, v: s + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Null where a vector has no length."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def is_finite(a: Column, dim: int) -> Column:
    """Whether a vector has `dim` numbers, none of them NaN or infinite."""
    return (F.size(a) == dim) & F.forall(a, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


def restored(prefix: Column, text: Column, suffix: Column) -> Column:
    """A text between its prefix and suffix (null ones are empty), without line ends at its end."""
    return F.regexp_replace(F.concat(F.coalesce(prefix, F.lit("")), text, F.coalesce(suffix, F.lit(""))), r"\n+$", "")


def json_answer(c: Column) -> Column:
    """The answer in a JSON text: the first element of a list, the first value of an object, a scalar itself; what is no JSON stays as it is."""
    key = F.get(F.json_object_keys(c), F.lit(0))
    scalar = F.get_json_object(c, "$")
    in_object = F.get(F.map_values(F.from_json(c, "map<string,string>")), F.lit(0))
    return F.when(F.json_array_length(c).isNotNull(), F.get_json_object(c, "$[0]")).when(key.isNotNull(), in_object).otherwise(F.coalesce(scalar, c))


def normalized_path(c: Column) -> Column:
    """A path or address with forward slashes, without anchor and query, and of an address without its scheme and host."""
    plain = F.regexp_replace(F.replace(c, F.lit("\\"), F.lit("/")), r"[#?].*$", "")
    return F.regexp_replace(F.regexp_replace(plain, r"^[a-z]+://[^/]*/?", ""), r"^(\./)+", "")


def base_name(c: Column) -> Column:
    return F.regexp_extract(c, r"([^/]*)$", 1)


def clip_key(c: Column) -> Column:
    """A clip's name without the start and end times at its end."""
    return F.regexp_replace(c, r"_[0-9]+(\.[0-9]+)?_[0-9]+(\.[0-9]+)?$", "")


def flat_content(parts: Column) -> Column:
    """The texts of a message's parts, one to a line; null and empty ones are left out."""
    return F.array_join(F.filter(parts, lambda x: F.coalesce(x, F.lit("")) != ""), "\n")


def qa_pairs(c: Column) -> Column:
    """Pairs of "Question: ..." and "Answer: ..." lines as (question, answer)."""
    pattern = r"Question: ([^\n]+)\nAnswer: ([^\n]+)"
    zipped = F.arrays_zip(F.regexp_extract_all(c, F.lit(pattern), 1).alias("question"), F.regexp_extract_all(c, F.lit(pattern), 2).alias("answer"))
    return F.transform(zipped, lambda x: F.struct(F.trim(x["question"]).alias("question"), F.trim(x["answer"]).alias("answer")))


def sampled_category(values: list[str], key: Column) -> Column:
    """One of some values, fixed by a key."""
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(md5_int(key), F.lit(len(values))) + 1).cast("int"))


def segment_budget(max_input: int, prefix_tokens: int) -> int:
    """Tokens of a segment that fit into a prompt besides its prefix and two marks."""
    return max_input - prefix_tokens - 2

"""Conversations: validity, ChatML rendering, role chunks, splits at thoughts."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def is_valid(messages: Column) -> Column:
    """A conversation with a tool call needs a "# Tools" section somewhere; one without messages isn't valid."""
    has = lambda s: F.exists(messages, lambda m: F.coalesce(m["content"], F.lit("")).contains(s))
    return (F.size(messages) > 0) & (~has("<tool_call>") | has("# Tools"))


def chatml(messages: Column) -> Column:
    """ChatML of messages without tools, as an expression: a system block first, empty where there is none, then every other turn."""
    block = lambda r, c: F.concat(F.lit(START), r, F.lit("\n"), F.coalesce(c, F.lit("")), F.lit(f"{END}\n"))
    first = messages[0]
    system = F.when(first["role"] == "system", first["content"]).otherwise(F.lit(""))
    rest = F.filter(messages, lambda m, i: (m["role"] != "system") | (i > 0))
    return F.concat(block(F.lit("system"), system), F.array_join(F.transform(rest, lambda m: block(m["role"], m["content"])), ""))


def thoughts_filled(reasoning: Column) -> Column:
    """Whether a turn has thoughts that aren't blank."""
    return F.coalesce(F.trim(reasoning), F.lit("")) != ""


def normalize_arguments(call: dict) -> dict:
    """Arguments of a tool call given as JSON text become an object; text that is none is an error."""
    args = call.get("function", call).get("arguments")
    if isinstance(args, str):
        args = json.loads(args)
        if not isinstance(args, dict):
            raise ValueError("arguments must be an object")
    target = dict(call.get("function", call)) | {"arguments": args or {}}
    return {**call, "function": target} if "function" in call else target


def chunks(messages: list[dict], tools: list[dict] | None = None, keep_history_thoughts: bool = False) -> list[tuple[str, str]]:
    """(role, text) of a conversation in order; the texts joined are the whole rendering.

    The system block is always there and holds the tools. Thoughts go before an assistant's text; those before the last user turn are
    emptied unless kept. Tool answers in a row share one user block.
    """
    rest = list(messages)
    system = rest.pop(0).get("content") or "" if rest and rest[0]["role"] == "system" else ""
    if tools:
        listed = "\n".join(json.dumps(t, ensure_ascii=False) for t in tools)
        system = f"{system}\n\n# Tools\n\n<tools>\n{listed}\n</tools>".strip("\n")
    out = [("system", f"{START}system\n{system}{END}\n")]
    last_user = max((i for i, m in enumerate(rest) if m["role"] == "user"), default=-1)
    i = 0
    while i < len(rest):
        m = rest[i]
        content = m.get("content") or ""
        if m["role"] == "tool":
            j, parts = i, []
            while j < len(rest) and rest[j]["role"] == "tool":
                parts.append(f"<tool_response>\n{rest[j].get('content') or ''}\n</tool_response>\n")
                j += 1
            out.append(("user", f"{START}user\n{''.join(parts)}{END}\n"))
            i = j
            continue
        if m["role"] == "assistant":
            thought = m.get("reasoning_content")
            thought = thought.strip() if isinstance(thought, str) else ""
            if "</think>" in content and not thought:
                before, _, content = content.partition("</think>")
                thought, content = before.replace("<think>", "").strip(), content.lstrip("\n")
            if i < last_user and not keep_history_thoughts:
                thought = ""
            body = f"<think>\n{thought}\n</think>\n{content}" if thought else f"<think></think>{content}"
            for call in m.get("tool_calls") or []:
                f = normalize_arguments(call)
                f = f.get("function", f)
                params = "".join(f"<parameter={k}>\n{v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)}\n</parameter>\n" for k, v in f["arguments"].items())
                body += f"\n<tool_call>\n<function={f['name']}>\n{params}</function>\n</tool_call>"
            out.append(("assistant", f"{START}assistant\n{body}{END}\n"))
        else:
            out.append((m["role"], f"{START}{m['role']}\n{content}{END}\n"))
        i += 1
    return out


def split_at_thoughts(messages: list[dict]) -> list[list[dict]]:
    """With thoughts, one sequence for each user turn: all up to the next user turn; a prefix that ends with a user turn is left out. Without, the whole."""
    if not any(isinstance(m.get("reasoning_content"), str) and m["reasoning_content"].strip() for m in messages):
        return [messages]
    users = [i for i, m in enumerate(messages) if m["role"] == "user"]
    ends = [*users[1:], len(messages)]
    return [messages[:e] for e in ends if messages[:e] and messages[:e][-1]["role"] != "user"]


def render(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(id_col, seq, pos, role, chunk): the role chunks of each sequence of conversations given as JSON {messages, tools}; bad ones give one row with a null role and the error as chunk."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if text is None:
                    continue
                try:
                    record = json.loads(text)
                    for s, part in enumerate(split_at_thoughts(record["messages"])):
                        rows += [(i, s, p, role, c) for p, (role, c) in enumerate(chunks(part, record.get("tools")))]
                except (ValueError, KeyError, TypeError, AttributeError) as e:
                    rows.append((i, 0, 0, None, f"{type(e).__name__}: {e}"))
            cols = list(zip(*rows)) if rows else [[]] * 5
            kinds = [b.schema.field(0).type, pa.int32(), pa.int32(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], [id_col, "seq", "pos", "role", "chunk"])

    return df.select(id_col, json_col).mapInArrow(run, f"`{id_col}` {kind}, seq int, pos int, role string, chunk string")


def system_and_user(chunk: Column) -> Column:
    """A first chunk that holds the system block and a user's turn as (system, user); without a user's turn that part is null."""
    at = F.locate(f"{START}user\n", chunk)
    return F.when(at > 0, F.struct(F.substring(chunk, F.lit(1), at - 1).alias("system"), F.substring(chunk, at, F.length(chunk)).alias("user"))).otherwise(F.struct(chunk.alias("system"), F.lit(None).cast("string").alias("user")))

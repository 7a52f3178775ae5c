"""Chat rendering (P07/P08) of an ordered message array to one string.

Fixed values of the chat template (role markers, default system text)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Template markers, default system prompt and the tools preamble.
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"
DEFAULT_SYSTEM = "You are Qwen, created by Alibaba Cloud. You are a helpful assistant."
TOOLS_INTRO = (
    "\n\n# Tools\n\nYou may call one or more functions to assist with the user query.\n\n"
    "You are provided with function signatures within <tools></tools> XML tags:\n<tools>"
)
TOOLS_OUTRO = (
    "\n</tools>\n\nFor each function call, return a json object with function name and arguments within "
    '<tool_call></tool_call> XML tags:\n<tool_call>\n{"name": <function-name>, "arguments": <args-json-object>}\n'
    "</tool_call>" + IM_END + "\n"
)


def render(
    msgs: Column,
    add_generation_prompt: bool = False,
    tools: Column | None = None,
    tool_calls: bool = False,
    calls_type: str = "array<struct<name:string,arguments:string>>",
) -> Column:
    """``msgs``: ``ARRAY<STRUCT<role, text[, tool_calls ARRAY<STRUCT<name, arguments>>]>>``
    ordered by turn; ``arguments`` is the JSON text of the call's arguments.
    ``tools``: optional ``ARRAY<STRING>`` of JSON tool signatures;
    ``tool_calls=True`` when the message struct carries that field.

    The header is the first system message or the default (inside the tools
    preamble when tools are given); a leading system message is not
    repeated; assistant tool calls are rendered as ``<tool_call>`` blocks;
    consecutive ``tool`` messages share one user block.  ``msgs`` must be a
    column (it is indexed inside the lambda)."""
    first = F.element_at(msgs, 1)
    sys_text = F.when(first["role"] == "system", first["text"]).otherwise(F.lit(DEFAULT_SYSTEM))
    plain_header = F.concat(F.lit(IM_START + "system\n"), sys_text, F.lit(IM_END + "\n"))
    if tools is not None:
        listed = F.array_join(F.transform(tools, lambda t: F.concat(F.lit("\n"), t)), "")
        header = F.when(
            F.coalesce(F.size(tools), F.lit(0)) > 0,
            F.concat(F.lit(IM_START + "system\n"), sys_text, F.lit(TOOLS_INTRO), listed, F.lit(TOOLS_OUTRO)),
        ).otherwise(plain_header)
    else:
        header = plain_header
    n = F.size(msgs)

    def calls(m):
        if not tool_calls:
            return F.lit("")
        one = lambda c: F.concat(
            F.lit('\n<tool_call>\n{"name": "'), c["name"], F.lit('", "arguments": '), c["arguments"], F.lit("}\n</tool_call>")
        )
        return F.array_join(F.transform(F.coalesce(m["tool_calls"], F.array().cast(calls_type)), one), "")

    def has_calls(m):
        if not tool_calls:
            return F.lit(False)
        return F.coalesce(F.size(m["tool_calls"]), F.lit(0)) > 0

    def one(m, i):
        prev_role = F.when(i > 0, F.element_at(msgs, i)["role"])
        next_role = F.when(i + 1 < n, F.element_at(msgs, i + 2)["role"])
        tool = F.concat(
            F.when((i == 0) | (prev_role != "tool"), F.lit(IM_START + "user")).otherwise(F.lit("")),
            F.lit("\n<tool_response>\n"),
            m["text"],
            F.lit("\n</tool_response>"),
            F.when((i + 1 == n) | (next_role != "tool"), F.lit(IM_END + "\n")).otherwise(F.lit("")),
        )
        with_calls = F.concat(
            F.lit(IM_START + "assistant"),
            F.when(F.coalesce(m["text"], F.lit("")) != "", F.concat(F.lit("\n"), m["text"])).otherwise(F.lit("")),
            calls(m),
            F.lit(IM_END + "\n"),
        )
        plain = F.concat(F.lit(IM_START), m["role"], F.lit("\n"), m["text"], F.lit(IM_END + "\n"))
        return (
            F.when((m["role"] == "system") & (i == 0), F.lit(""))
            .when(m["role"] == "tool", tool)
            .when((m["role"] == "assistant") & has_calls(m), with_calls)
            .when(m["role"].isin("user", "assistant", "system"), plain)
            .otherwise(F.lit(""))  # the template emits nothing for other roles
        )

    body = F.array_join(F.transform(msgs, one), "")
    tail = F.lit(IM_START + "assistant\n") if add_generation_prompt else F.lit("")
    return F.concat(header, body, tail)


def section(prompt: Column, name: str) -> Column:
    """Text of a ``NAME:`` section of a Reddit-style prompt (up to the next
    blank line), e.g. SUBREDDIT, TITLE, POST; '' when absent."""
    return F.regexp_extract(prompt, rf"(?s){name}:\s*(.*?)(?:\n\n|$)", 1)

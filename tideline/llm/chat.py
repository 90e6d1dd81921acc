"""Chat formatting by incremental rendering of a template that is treated as a black box."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.common import with_columns

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

# A private-use character that stands for a turn's text while the text is being located.
PROBE = ""
END = "</turn>\n"
SPECIAL = re.compile(r"[\\#<:]")
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
TURN = re.compile(r"### ((?:[^\\#<:]+|\\.)*): ((?:[^\\#<:]+|\\.)*)</turn>\n", re.DOTALL)


def escape(text: str) -> str:
    """Control strings need ``#``, ``<`` or ``:``, so these, and the mark itself, get a backslash."""
    return SPECIAL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def turn_template(turns: list[Turn]) -> str:
    """``### role: text</turn>`` and a line end per turn, roles and texts escaped."""
    return "".join(f"### {escape(role)}: {escape(text)}{END}" for role, text in turns)


def parse(formatted: str) -> list[Turn]:
    """The turns that ``turn_template`` rendered."""
    return [(unescape(role), unescape(text)) for role, text in TURN.findall(formatted)]


def common_start(a: str, b: str) -> int:
    """Length of the longest common prefix, by bisection over slices."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def locate(turns: list[Turn], template: Template) -> tuple[str, list[tuple[int, int, int, int] | None], bool]:
    """The rendering of all turns; (start, end, text start, text end) per turn; whether history was rewritten.

    The prefixes of one, two, ... turns are rendered and consecutive outputs compared. What
    follows their common start is the new turn. A template that changes what it had rendered
    before the last turn's text ended rewrites history. Each turn is rendered once more with a
    probe character in place of its text, which gives the borders of the text. A turn that does
    not stand in the last output as it did in its own has no span.
    """
    used = set().union(*(text for _, text in turns), *(role for role, _ in turns))
    probe = next(c for c in map(chr, range(0xE000, 0x110000)) if c not in used)
    before, text_end, found, rewrites = "", 0, [], False
    for k, (role, _) in enumerate(turns):
        output = template(turns[: k + 1])
        start = common_start(before, output)
        rewrites |= start < text_end
        probed = template([*turns[:k], (role, probe)])
        at, text_end = probed.find(probe), len(output) - (len(probed) - probed.find(probe) - 1)
        if probed.count(probe) == 1 and output[:at] == probed[:at] and output[text_end:] == probed[at + 1 :]:
            start = min(start, at)
            found.append((start, at, text_end, output[start:text_end]))
        else:
            found.append(None)
            text_end = start
        before = output
    spans, end = [], len(before)
    for place in reversed(found):
        if place and before[place[0] : place[2]] == place[3]:
            spans.append((place[0], end, place[1], place[2]))
            end = place[0]
        else:
            spans.append(None)
    return before, spans[::-1], rewrites


SPAN = T.StructType([T.StructField(n, T.LongType()) for n in ("turn_start", "turn_end", "text_start", "text_end")])
OUTPUT = T.StructType(
    [
        T.StructField("formatted", T.StringType()),
        T.StructField("spans", T.ArrayType(SPAN)),
        T.StructField("loss_spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("rewrites_history", T.BooleanType()),
    ]
)


def format_conversations(
    df: DataFrame, template: Template = turn_template, trained: tuple[str, ...] = ("assistant",)
) -> DataFrame:
    """One row per conv_id: the formatted text, spans per turn, the loss mask as spans of texts.

    Turns are ordered by turn (NULL last), role and text, so equal rows stay and ties are settled.
    NULL role or text counts as empty; rows with NULL conv_id form one conversation. Other
    columns are ignored. A conversation is one record of the output, so its turns meet in one
    task, and prefixes are rendered anew for each turn: work grows with the square of the turns
    of one conversation. Spans are offsets in code points; a turn without one is NULL.
    """
    turn = F.struct(
        F.col("turn").isNull().alias("last"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    grouped = df.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    grouped = grouped.select(
        "conv_id",
        F.transform("turns", lambda t: t["role"]).alias("roles"),
        F.transform("turns", lambda t: t["text"]).alias("texts"),
        F.size("turns").cast("long").alias("n_turns"),
    )

    def compute(batch: pa.RecordBatch) -> list:
        rows = []
        for roles, texts in zip(batch.column("roles").to_pylist(), batch.column("texts").to_pylist()):
            formatted, spans, rewrites = locate(list(zip(roles, texts)), template)
            loss = [[s[2], s[3]] for role, s in zip(roles, spans) if s and role in trained]
            names = SPAN.fieldNames()
            rows.append((formatted, [s and dict(zip(names, s)) for s in spans], loss, rewrites))
        return [list(column) for column in zip(*rows)]

    return with_columns(grouped, None, OUTPUT, compute).drop("roles", "texts")


READ_BACK = T.StructType(
    [
        T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()),
        T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType()),
    ]
)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted texts and their loss masks hold, unescaped."""

    def digest(pieces):
        made = hashlib.sha256()
        for piece in pieces:
            made.update(piece.encode("utf-8", "surrogatepass"))
        return made.hexdigest()

    def compute(batch: pa.RecordBatch) -> list:
        rows = []
        for text, loss in zip(batch.column("formatted").to_pylist(), batch.column("loss_spans").to_pylist()):
            turns = parse(text)
            trained = [unescape(text[start:end]) for start, end in loss]
            whole = digest(f"{role}\n{said}\n" for role, said in turns)
            rows.append((len(turns), whole, sum(map(len, trained)), digest(trained), len(text)))
        return [list(column) for column in zip(*rows)]

    df = formatted.select("conv_id", "formatted", "loss_spans", "rewrites_history")
    return with_columns(df, "formatted", READ_BACK, compute).drop("formatted", "loss_spans")

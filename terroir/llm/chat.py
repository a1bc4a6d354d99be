"""Chat formatting by a finite-state machine over roles and a declarative template.

The machine checks the order of turns (an optional system turn, then user and assistant in turn); a turn out of
order is still formatted and marked. Each turn becomes text segments with a loss flag each; only the text of
roles with ``loss`` is under the mask. Control strings inside texts get a backslash before them, and so does a
backslash, so that formatted text can be read back. Other roles than the template's are marked by name.

Turns are dealt by conversation and sorted by turn, then role and text; a partition is read as a stream with one
turn in memory at a time, so a conversation of any length takes bounded memory.

Defined results: null text or role counts as empty; a null turn comes first; turns of null conversations form one
conversation; repeated turns are all formatted; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: begin: before a conversation; roles: prefix, suffix and whether the text is under the loss mask.
TEMPLATE = {
    "begin": "<s>",
    "roles": {
        "system": ("<<SYS>>\n", "\n<</SYS>>\n\n", False),
        "user": ("[INST] ", " [/INST]", False),
        "assistant": (" ", " </s>", True),
    },
    "other": ("[ROLE=", "]", "[/ROLE]"),
    "controls": ("<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "[ROLE=", "[/ROLE]"),
    #: the machine: from the last role ("" at the start) to the roles that may follow
    "order": {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
}
_SEGMENTS = "conv_id long, seq long, role string, in_order boolean, segments array<struct<text string, loss boolean>>"


class Template:
    def __init__(self, spec: dict):
        self.begin, self.roles, self.other, self.order = spec["begin"], spec["roles"], spec["other"], spec["order"]
        self.escaped = re.compile("|".join(map(re.escape, ("\\", *spec["controls"]))))
        self.closing = {r: re.compile(r"\\.|(" + re.escape(s) + ")", re.S) for r, (_, s, _) in self.roles.items()}
        self.name_end, self.other_end = (re.compile(r"\\.|(" + re.escape(s) + ")", re.S) for s in self.other[1:])

    def escape(self, text: str) -> str:
        return self.escaped.sub(lambda m: "\\" + m[0], text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.S)

    def segments(self, role: str, text: str, first: bool) -> list[tuple[str, bool]]:
        if role in self.roles:
            before, after, loss = self.roles[role]
        else:
            before, after, loss = self.other[0] + self.escape(role).replace("]", "\\]") + self.other[1], self.other[2], False
        return [(self.begin * first + before, False), (self.escape(text), loss), (after, False)]

    def read(self, formatted: str) -> tuple[str, str]:
        """Role and text of one formatted turn."""
        rest = formatted.removeprefix(self.begin)
        if rest.startswith(self.other[0]):
            end = next(m for m in self.name_end.finditer(rest, len(self.other[0])) if m[1])
            role, start, closing = self.unescape(rest[len(self.other[0]) : end.start()]), end.end(), self.other_end
        else:
            role = next(r for r, (p, _, _) in self.roles.items() if rest.startswith(p))
            start, closing = len(self.roles[role][0]), self.closing[role]
        stop = next(m for m in closing.finditer(rest, start) if m[1])
        return role, self.unescape(rest[start : stop.start()])


def format_turns(df: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """From rows (conv_id, turn, role, text): one row per turn in order, with its segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spec, state, conv, seq, begun = Template(template), "", None, 0, False
        for b in batches:
            out = []
            for c, role, text in zip(*(b.column(k).to_pylist() for k in ("conv_id", "role", "text")), strict=True):
                if not begun or c != conv:
                    conv, seq, state, begun = c, 0, "", True
                out.append((c, seq, role, role in spec.order.get(state, ()), [{"text": t, "loss": loss} for t, loss in spec.segments(role, text, seq == 0)]))
                state, seq = role, seq + 1
            if out:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["conv_id", "seq", "role", "in_order", "segments"])

    turns = df.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, _SEGMENTS)


def read_back(formatted: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """Digests of each conversation, from the formatted turns as ``format_turns`` leaves them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spec, now, done = Template(template), None, []

        def result(x: dict) -> tuple:
            return x["conv"], x["n"], x["turns"].hexdigest(), x["loss_chars"], x["loss"].hexdigest(), x["chars"], x["in_order"]

        for b in batches:
            for c, seq, in_order, segments in zip(*(b.column(k).to_pylist() for k in ("conv_id", "seq", "in_order", "segments")), strict=True):
                if seq == 0:
                    done += [result(now)] if now else []
                    now = {"conv": c, "n": 0, "turns": hashlib.sha256(), "loss_chars": 0, "loss": hashlib.sha256(), "chars": 0, "in_order": True}
                whole = "".join(s["text"] for s in segments)
                role, text = spec.read(whole)
                masked = "".join(spec.unescape(s["text"]) for s in segments if s["loss"])
                now["n"] += 1
                now["turns"].update(f"{role}\n{text}\n".encode())
                now["loss"].update(masked.encode())
                now["loss_chars"] += len(masked)
                now["chars"] += len(whole)
                now["in_order"] &= in_order
            if len(done) > 1000:
                yield _rows(done)
                done = []
        done += [result(now)] if now else []
        if done:
            yield _rows(done)

    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, in_order boolean")


def _rows(done: list[tuple]) -> pa.RecordBatch:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "in_order"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*done, strict=True), kinds, strict=True)], names=names)


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return read_back(format_turns(turns.unionByName(extra)))


SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
t AS (SELECT *, lag(role, 1, '') OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS last_role,
        length(text) + len(regexp_extract_all(text, '\\|<s>|</s>|<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|\[ROLE=|\[/ROLE\]'))
        + CASE role WHEN 'system' THEN 8 + 11 WHEN 'user' THEN 7 + 8 WHEN 'assistant' THEN 1 + 5 ELSE 6 + length(role) + 1 + 7 END AS chars FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       (3 + sum(chars))::BIGINT AS formatted_chars,
       bool_and(role || '>' || last_role IN ('system>', 'user>', 'user>system', 'assistant>user', 'user>assistant')) AS in_order
FROM t GROUP BY conv_id
"""

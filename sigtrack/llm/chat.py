"""Chat formatting with a grammar round trip.

A turn is rendered by its role's template; a deterministic parser reads it back, and if the
turn is not the same, its content is escaped and rendered again until it is. The parser takes
formatted text in pieces, so a conversation of any length is read back in the memory of one turn.

Grammar (roles are not escaped, but named in full where they are none of the three)::

    conversation = turn*
    turn   = "<<SYS>>\\n" body "\\n<</SYS>>\\n"          system
           | "[INST] " body " [/INST]"                   user
           | " " body "</s>"                             assistant, its body is under the loss mask
           | "[ROLE]" body "[AS]" body "[/ROLE]"         role and text of any other
    body   = (character | "\\\\" character)*             a backslash takes away what the next character means
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: The strings that mean something to the parser.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[AS]", "[/ROLE]")
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
OPEN = {"system": "<<SYS>>\n", "user": "[INST] ", "assistant": " "}
CLOSE = {"system": "\n<</SYS>>\n", "user": " [/INST]", "assistant": "</s>"}
_OTHER_OPEN, _AS, _OTHER_CLOSE = "[ROLE]", "[AS]", "[/ROLE]"
_CONVERSATION, _PROBE = -1, "</s>[INST] ok [/INST]"


def escaped(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text.replace("\\", "\\\\"))


def rendered(role: str, text: str, level: int) -> tuple[str, int, int]:
    """The turn, and where its loss mask starts and how long it is. Level 0 leaves the text as it is."""
    body = escaped(text) if level else text
    if role in OPEN:
        mask = (len(OPEN[role]), len(body)) if role == "assistant" else (0, 0)
        return OPEN[role] + body + CLOSE[role], *mask
    return _OTHER_OPEN + escaped(role) + _AS + body + _OTHER_CLOSE, 0, 0


class Parser:
    """Reads turns from text that comes in pieces; what is left of an unfinished turn waits."""

    def __init__(self):
        self.rest = ""

    def feed(self, text: str) -> list[tuple[str, str]]:
        data, at, out = self.rest + text, 0, []
        while at < len(data):
            found = self._turn(data, at)
            if found is None:
                break
            role, body, at = found
            out.append((role, body))
        self.rest = data[at:]
        return out

    def _turn(self, data: str, at: int) -> tuple[str, str, int] | None:
        for role, start in OPEN.items():
            if data.startswith(start, at):
                body = self._body(data, at + len(start), CLOSE[role])
                return None if body is None else (role, *body)
        if data.startswith(_OTHER_OPEN, at):
            role = self._body(data, at + len(_OTHER_OPEN), _AS)
            body = role and self._body(data, role[1], _OTHER_CLOSE)
            return (role[0], *body) if body else None
        if any(start.startswith(data[at:]) for start in (*OPEN.values(), _OTHER_OPEN)):
            return None
        raise ValueError(f"no turn starts at {data[at : at + 20]!r}")

    def _body(self, data: str, at: int, close: str) -> tuple[str, int] | None:
        """The text up to an unescaped ``close``; a control string of another kind is a fault."""
        parts = []
        while True:
            stop = data.find(close, at)
            if stop < 0:
                return None
            slash = data.find("\\", at, stop)
            if slash < 0:
                body = data[at:stop]
                if _CONTROL.search(body):
                    raise ValueError("a control string inside a turn")
                return "".join(parts) + body, stop + len(close)
            if _CONTROL.search(data, at, slash):
                raise ValueError("a control string inside a turn")
            parts += [data[at:slash], data[slash + 1 : slash + 2]]
            at = slash + 2


def formatted_turn(role: str, text: str) -> tuple[str, int, int]:
    """The plainest rendering that reads back as the same turn and nothing else."""
    for level in (0, 1):
        out = rendered(role, text, level)
        parser = Parser()
        try:
            if parser.feed(out[0]) == [(role, text)] and not parser.rest:
                return out
        except ValueError:
            continue
    raise ValueError("an escaped turn does not read back")


TURNS = "conv_id long, turn long, formatted string, mask_start long, mask_length long"


def format_turns(conversations: DataFrame) -> DataFrame:
    """Each turn's formatted text and its loss mask (code points, within the turn).

    A conversation's text is its turns' in order of turn; rows with the same turn follow each
    other in the order of their formatted text. Null role and null text count as empty; null
    conv_id is a conversation of its own. Further columns are left alone.
    """

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            found = [formatted_turn(r or "", t or "") for r, t in zip(frame["role"].to_pylist(), frame["text"].to_pylist())]
            text, start, length = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([frame["conv_id"], frame["turn"], pa.array(text, pa.string()), pa.array(start, pa.int64()), pa.array(length, pa.int64())], [c.split()[0] for c in TURNS.split(", ")])

    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    return rows.mapInArrow(run, TURNS)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(turns: DataFrame) -> DataFrame:
    """Per conversation what the formatted text holds: turns by the parser, loss text by the mask.

    A digest needs a conversation's turns in one row after another; they stream through, sorted,
    and only the digests' state is held.
    """

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: list | None = None

        def row(o: list) -> tuple:
            if o[1].rest:
                raise ValueError("an unfinished turn")
            return o[0], o[2], o[3].hexdigest(), o[4], o[5].hexdigest(), o[6]

        done = []
        for frame in frames:
            for conv, text, start, length in zip(*(frame[c].to_pylist() for c in ("conv_id", "formatted", "mask_start", "mask_length"))):
                if own is None or own[0] != conv:
                    done += [row(own)] if own else []
                    own = [conv, Parser(), 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in own[1].feed(text):
                    own[2] += 1
                    own[3].update(f"{role}\n{body}\n".encode())
                loss = re.sub(r"\\(.)", r"\1", text[start : start + length], flags=re.S)
                own[4] += len(loss)
                own[5].update(loss.encode())
                own[6] += len(text)
            columns, done = list(zip(*done)) or [()] * 6, []
            yield _digests(columns)
        if own:
            yield _digests(list(zip(row(own))))

    def _digests(columns: list) -> pa.RecordBatch:
        fields = [f.split() for f in DIGESTS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if kind == "long" else pa.string()) for c, (_, kind) in zip(columns, fields)], [name for name, _ in fields])

    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted").mapInArrow(run, DIGESTS)


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.range(2).select(F.lit(_CONVERSATION).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(_PROBE).alias("text"))
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return read_back(format_turns(rows.unionByName(probe)))


ORACLE = {
    "op10_chat": r"""
WITH c AS (
  SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, len(regexp_extract_all(text, '\\|</?s>|\[/?INST\]|<</?SYS>>|\[/?ROLE\]|\[AS\]')) AS marks,
         CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 15 WHEN 'assistant' THEN 5 ELSE 17 + length(role) END AS frame
  FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(frame + length(text) + marks)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
}

"""Chat formatting in budgeted windows.

Running (prefix) sums of turn tokens choose turn-aligned spans: a window takes new turns while they fit the budget, at least
one. Every window after a conversation's first repeats its system turn, and up to ``history`` turns before the span, as long as both
leave half of the budget; their texts are masked, so every assistant text is a target once. Turns are marked by control
strings; control strings inside texts, ours and those of other common templates, are escaped reversibly.

Conversations stream through a task in turn order, so memory holds one window and the history, however long they are.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import DataFrame, functions as F

# The template, and control strings of templates that are escaped in texts.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
CONTROL = ["<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
TARGET_ROLE, SYSTEM_ROLE = "assistant", "system"
#: Tokens of a window, turns repeated at most, tokens that a turn's marks take.
BUDGET, HISTORY, MARKS = 512, 2, 4
PARSED = re.compile(rf"{re.escape(TURN)}(.*?){re.escape(TEXT)}(.*?){re.escape(END)}", re.DOTALL)
WINDOW = "conv_id long, window int, repeated int, turns int, tokens long, text string, loss array<struct<start:int,end:int>>"


def escape(text: str) -> str:
    """Backslashes doubled, and one put after the first character of each control string."""
    text = text.replace("\\", "\\\\")
    for c in CONTROL:
        if c in text:
            text = text.replace(c, f"{c[0]}\\{c[1:]}")
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text


def _window(conv, number: int, repeated: list, turns: list) -> tuple:
    parts, loss, at = [], [], 0
    for i, (role, text, _) in enumerate([*repeated, *turns]):
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        if i >= len(repeated) and role == TARGET_ROLE:
            loss.append({"start": at + len(head), "end": at + len(head) + len(body)})
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return conv, number, len(repeated), len(turns), sum(n for *_, n in [*repeated, *turns]), "".join(parts), loss


class _Conversation:
    def __init__(self, conv, budget: int, history: int):
        self.conv, self.budget, self.history = conv, budget, history
        self.system, self.repeated, self.new, self.sum, self.number, self.seen = [], [], [], 0, 0, 0

    def add(self, role: str, text: str):
        """The window that this turn closes, if any."""
        turn = (role, text, len(text.split()) + MARKS)
        done = None
        if self.new and self.sum + turn[2] > self.budget:
            done = self.close()
            last = [t for t in self.new if t not in self.system][-self.history :] if self.history else []
            room, back = self.budget // 2 - sum(n for *_, n in self.system), []
            for t in reversed(last):
                room -= t[2]
                if room < 0:
                    break
                back.insert(0, t)
            while back and sum(n for *_, n in [*self.system, *back, turn]) > self.budget:
                back.pop(0)
            self.repeated, self.new = [*self.system, *back], []
            self.sum = sum(n for *_, n in self.repeated)
        if not self.seen and role == SYSTEM_ROLE:
            self.system = [turn] if turn[2] <= self.budget else []
        self.seen += 1
        self.new.append(turn)
        self.sum += turn[2]
        return done

    def close(self):
        done = _window(self.conv, self.number, self.repeated, self.new)
        self.number += 1
        return done


def format_windows(rows: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Windows of all conversations from (conv_id, turn, role, text): see WINDOW; loss holds code point spans in text.

    The system turn opens every window; beside one of over half of the budget no history is repeated, and a turn that doesn't fit
    beside it makes a window that is over the budget by what is missing. A system turn that alone is over the budget stands
    in its first window only. Turns go by turn (null last), role, text; repeated rows are turns of their own. Null role and text are empty; rows with a
    null conv_id form one conversation. A turn larger than the budget makes a window of its own, uncut. Other columns are left
    out. A conversation's windows stay in one partition, in order.
    """

    def formatted(batches):
        now, first = None, True
        for batch in batches:
            out = []
            for conv, role, text in zip(_ids(batch), batch["role"].tolist(), batch["text"].tolist(), strict=True):
                if first or conv != now.conv:
                    if not first:
                        out.append(now.close())
                    now, first = _Conversation(conv, budget, history), False
                if (done := now.add(role, text)) is not None:
                    out.append(done)
            if out:
                yield _frame(out)
        if not first:
            yield _frame([now.close()])

    kept = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = kept.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_last(), "role", "text")
    return ordered.withColumn("conv_id", F.col("conv_id").cast("string")).mapInPandas(formatted, WINDOW)


def _ids(batch: pd.DataFrame) -> list:
    """conv_id as text (so that ids beside nulls keep all digits) to numbers."""
    return [None if x is None else int(x) for x in batch["conv_id"].tolist()]


def _frame(out: list) -> pd.DataFrame:
    frame = pd.DataFrame(out, columns=["conv_id", "window", "repeated", "turns", "tokens", "text", "loss"])
    return frame.assign(conv_id=pd.array(frame["conv_id"], dtype="Int64"))


def read_back(windows: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from the windows' text and masks alone.

    Takes windows as format_windows leaves them: each conversation's in one partition and in order.
    """

    def read(batches):
        now, first = None, True
        for batch in batches:
            out = []
            for conv, repeated, text, loss in zip(_ids(batch), batch["repeated"].tolist(), batch["text"].tolist(), batch["loss"].tolist(), strict=True):
                if first or conv != now[0]:
                    if not first:
                        out.append((*now[:2], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5]))
                    now, first = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0], False
                for i, m in enumerate(PARSED.finditer(text)):
                    if i >= repeated:
                        now[1] += 1
                        now[2].update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
                for span in loss:
                    said = unescape(text[span["start"] : span["end"]])
                    now[3] += len(said)
                    now[4].update(said.encode())
                now[5] += len(text)
            if out:
                yield done(out)
        if not first:
            yield done([(*now[:2], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5])])

    def done(out):
        frame = pd.DataFrame(out, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
        return frame.assign(conv_id=pd.array(frame["conv_id"], dtype="Int64"))

    return windows.withColumn("conv_id", F.col("conv_id").cast("string")).mapInPandas(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def digest(conversations: DataFrame) -> DataFrame:
    """All conversations and conversation -7, whose texts are control strings of another template."""
    spark = conversations.sparkSession
    odd = spark.createDataFrame([(-7, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(("user", "assistant"))], "conv_id long, turn long, role string, text string")
    return read_back(format_windows(conversations.select("conv_id", "turn", "role", "text").unionByName(odd)))

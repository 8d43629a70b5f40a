"""Chat formatting in budgeted windows.

A conversation's turns, in order, are cut where the prefix sum of their tokens passes the budget, so every
window holds whole turns. A window starts with the system turn and a limited piece of the turns before
it, both repeated and outside the loss mask; the mask covers the texts of new assistant turns, each in
one window only. A window also ends after every PART_TURNS-th turn of a conversation, so that a long conversation
is dealt over tasks; the next part is handed the system turn and the last turns before it, so its first
window repeats history like any other. The template marks turns with control strings; inside texts these are escaped
reversibly, by one backslash more between "<" and "|".
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardwise.session import materialize

OPEN, CLOSE, LINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
BUDGET, HISTORY_TURNS, HISTORY_TOKENS = 512, 2, 128
#: Turns of a part.
PART_TURNS = 1024
TURN_TOKENS = 4  # of the template
SYSTEM, HISTORY, FRESH = 0, 1, 2  # what a part is handed, and its own turns
MOST_BROADCAST = 100_000
_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Turns (role, text) of a formatted window, as they were before escaping."""
    turns = []
    for part in formatted.split(OPEN)[1:]:
        role, _, text = part.partition("\n")
        turns.append((unescape(role.replace(LINE, "\n")), unescape(text[:text.index(CLOSE)])))
    return turns


def token_count(text: Column) -> Column:
    """An estimate that needs no vocabulary: words of letters and digits, and other characters one by one."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[A-Za-z0-9]+|[^A-Za-z0-9\s]"))


def _windows(budget: int, history_turns: int, history_tokens: int):
    def build(conv, part, number, system, history, fresh):
        text, at, loss = [], 0, []
        repeated = ([system] if system else []) + list(history)
        for i, (role, body, _) in enumerate([*repeated, *fresh]):
            head = f"{OPEN}{escape(role).replace(chr(10), LINE)}\n"
            inner = escape(body)
            if i >= len(repeated) and role == "assistant":
                loss.append({"start": at + len(head), "end": at + len(head) + len(inner)})
            text.append(f"{head}{inner}{CLOSE}\n")
            at += len(text[-1])
        return {"conv_id": conv, "part": part, "window": number, "n_repeated": len(repeated), "n_turns": len(fresh),
                "n_tokens": sum(t for _, _, t in [*repeated, *fresh]), "formatted": "".join(text), "loss": loss}

    def of_part(conv, part, rows) -> Iterator[dict]:
        before, fresh, number = deque(maxlen=history_turns), [], 0
        system = handed = None  # as known so far, and as known from earlier parts
        total = start = 0  # prefix sums: of all turns, and up to the window
        lead, history, extra = None, [], 0  # what the window repeats, and its tokens

        def repeat() -> tuple:
            found, room = [], history_tokens
            for old in reversed(before):
                if old[2] > room or old is system:
                    break
                found.insert(0, old)
                room -= old[2]
            return system, found, sum(t for _, _, t in found) + (system[2] if system else 0)

        for row in rows:
            turn = (row["role"] or "", row["text"] or "", row["tokens"] + TURN_TOKENS)
            if row["kind"] == SYSTEM:
                handed = system = turn
                continue
            if row["kind"] == HISTORY:
                # the system turn, if it stands among the last turns, is repeated already
                before.append(system if turn == handed else turn)
                continue
            if not fresh and not number:
                lead, history, extra = repeat()
            if fresh and total + turn[2] - start + extra > budget:
                yield build(conv, part, number, lead, history, fresh)
                number, start, fresh = number + 1, total, []
                lead, history, extra = repeat()
            if system is None and turn[0] == "system":
                system = turn
            fresh.append(turn)
            before.append(turn)
            total += turn[2]
        if fresh:
            yield build(conv, part, number, lead, history, fresh)

    def run(batches: Iterator[pa.RecordBatch]):
        rows = (row for batch in batches for at in range(0, batch.num_rows, 512) for row in batch.slice(at, 512).to_pylist())
        held, size = [], 0
        for (conv, part), group in groupby(rows, key=lambda r: (r["conv_id"], r["part"])):
            for window in of_part(conv, part, group):
                held.append(window)
                size += len(window["formatted"])
                if size > 1 << 20:
                    yield pa.RecordBatch.from_pylist(held, schema=_WINDOW)
                    held, size = [], 0
        yield pa.RecordBatch.from_pylist(held, schema=_WINDOW)

    return run


def _parted(rows: DataFrame) -> DataFrame:
    """rows with `pos`, their place in the conversation, in those of more than PART_TURNS turns; else null.

    Places come from a range partitioning and running counts of the partitions, so no conversation has to fit a
    task.
    """
    long = materialize(rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > PART_TURNS)
                       .select(F.col("conv_id").alias("_long")), "long")
    n_long = long.count()  # at most one in PART_TURNS rows
    if not n_long:
        return rows.withColumn("pos", F.lit(None).cast("long"))
    side = F.broadcast(long) if n_long <= MOST_BROADCAST else long
    met = F.col("conv_id").eqNullSafe(F.col("_long"))
    tie = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 16))  # equal rows may be many
    order = ["conv_id", "turn", "role", "text", "_tie"]
    laid = materialize(rows.join(side, met, "left_semi").withColumn("_tie", tie).repartitionByRange(*order).sortWithinPartitions(*order)
                       .withColumn("_at", F.monotonically_increasing_id()), "laid")
    part = F.shiftright("_at", 33)
    shift = materialize(laid.groupBy(part.alias("_part")).count().select("_part", F.coalesce(F.sum("count").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_shift")), "shift")  # a row per partition
    placed = laid.join(F.broadcast(shift), part == F.col("_part")).withColumn(
        "_row", F.col("_shift") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    first = materialize(placed.groupBy(F.col("conv_id").alias("_conv")).agg(F.min("_row").alias("_first")), "first")
    first = F.broadcast(first) if n_long <= MOST_BROADCAST else first
    placed = placed.join(first, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(*rows.columns, (F.col("_row") - F.col("_first")).alias("pos"))
    return rows.join(side, met, "left_anti").withColumn("pos", F.lit(None).cast("long")).union(placed)


_WINDOW = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int64()), ("window", pa.int64()), ("n_repeated", pa.int32()), ("n_turns", pa.int32()),
    ("n_tokens", pa.int64()), ("formatted", pa.string()), ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])
_WINDOW_SQL = ("conv_id long, part long, window long, n_repeated int, n_turns int, n_tokens long, formatted string, "
               "loss array<struct<start:int,end:int>>")


def format_windows(conversations: DataFrame, budget: int = BUDGET, history_turns: int = HISTORY_TURNS,
                   history_tokens: int = HISTORY_TOKENS, tokens: Column | None = None) -> DataFrame:
    """Rows (conv_id, part, window, n_repeated, n_turns, n_tokens, formatted, loss), loss in code points.

    Turns go by turn, nulls first, then role and text; null texts and roles are empty; repeated rows are turns
    of their own; rows without conv_id are one conversation. Other columns are ignored. A turn larger than the
    budget has a window of its own, whole. Tasks hold one window.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text",
        (token_count(F.col("text")) if tokens is None else tokens).cast("long").alias("tokens"))
    rows = _parted(rows)
    part = F.coalesce(F.floor(F.col("pos") / PART_TURNS), F.lit(0)).cast("long")
    rows = rows.withColumns({"part": part, "kind": F.lit(FRESH)})
    parted = rows.where("pos IS NOT NULL")
    # what later parts are handed: the last turns before them, and the conversation's first system turn
    follows = F.col("pos") % PART_TURNS >= PART_TURNS - min(history_turns, PART_TURNS)
    history = parted.where(follows).withColumns({"part": F.col("part") + 1, "kind": F.lit(HISTORY)})
    lasts = parted.groupBy("conv_id").agg(F.max("part").alias("last"), F.min(
        F.when(F.col("role") == "system", F.struct("pos", "turn", "role", "text", "tokens"))).alias("s"))
    lasts = materialize(lasts.select(F.col("conv_id").alias("_id"), "last", "s"), "lasts")
    history = history.join(lasts, F.col("conv_id").eqNullSafe(F.col("_id"))).where("part <= last").select(rows.columns)
    first = F.floor(F.col("s.pos") / PART_TURNS).cast("long") + 1
    system = lasts.where(first <= F.col("last")).select(
        F.col("_id").alias("conv_id"), "s.turn", "s.role", "s.text", "s.tokens", "s.pos", F.explode(F.sequence(first, F.col("last"))).alias("part"),
        F.lit(SYSTEM).alias("kind")).select(rows.columns)
    dealt = rows.union(history).union(system).repartition("conv_id", "part").sortWithinPartitions(
        "conv_id", "part", "kind", "turn", "role", "text")
    return dealt.select("conv_id", "part", "role", "text", "tokens", "kind").mapInArrow(
        _windows(budget, history_turns, history_tokens), _WINDOW_SQL)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    rows = (row for batch in batches for at in range(0, batch.num_rows, 256) for row in batch.slice(at, 256).to_pylist())
    out = []
    for conv, windows in groupby(rows, key=lambda r: r["conv_id"]):
        turns, loss, n, chars, size = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
        for w in windows:
            size += len(w["formatted"])
            for role, text in parse(w["formatted"])[w["n_repeated"]:]:
                turns.update(f"{role}\n{text}\n".encode())
                n += 1
            for span in w["loss"]:
                text = unescape(w["formatted"][span["start"]:span["end"]])
                loss.update(text.encode())
                chars += len(text)
        out.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), size))
        if len(out) == 4096:
            yield _summary(out)
            out = []
    yield _summary(out)


def _summary(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
             ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()))
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds)], [n for n, _ in kinds])


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation, parsed from the formatted windows alone: n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars. Tasks stream over windows and hold one."""
    return windows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "window").mapInArrow(
        _read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")

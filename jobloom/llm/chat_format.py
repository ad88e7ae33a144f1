"""Chat formatting in budgeted windows with a loss mask (operator 12).

Every turn is written as `<turn ROLE>`, a line break, its text, `</turn>` and a line break. A text
cannot fake a mark: after the `<` of anything that looks like one, with any number of
backslashes, one backslash is put in, and taken out again when the text is read back.

Where a conversation is cut follows from the prefix sums of its turns' tokens alone, so each row
decides for itself, however long the conversation is. With R tokens of room, the sums are ruled
into cells of R. The turns that lie inside one cell make a window; the turn that lies across the
end of a cell makes one of its own. So windows hold whole turns and at most `budget` tokens,
unless a single turn alone has more. Every window

- starts with the conversation's system turn (its first turn, if that is one of the role);
- repeats the turns that begin in the last `history / 2` tokens before its cell (at most `history`
  tokens), for context;
- has in its loss mask the texts of the target role, but not those it repeats: each is learnt once.

R is the budget less the system turn and the history. A system turn with more than a quarter of the
budget is not repeated: it counts as a turn like any other.

Rows are sorted over range partitions by conversation and turn; sums run on from partition to
partition through one row per partition. A window is put together from its own rows only, so a
conversation that holds a third of all turns is spread like any others.

Defined cases: a null text or role is the empty one; turns are in the order of `turn` (null last), then
of role, first characters and hash of the text; repeated rows are turns each; a null conversation id is
an id of its own; empty texts are turns with an empty text; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from jobloom.llm.textkit import slices
from jobloom.sources.storage import shared_folder

BUDGET = 1024
HISTORY = 256
SYSTEM, TARGET = "system", "assistant"
TAIL = "</turn>\n"
_TIE = 64  # characters of a text that order turns with equal place and role
_ROLE_SIGNS = (("%", "%25"), ("<", "%3C"), (">", "%3E"), ("\n", "%0A"))


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)(/?turn)", r"<\\$1$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)(/?turn)", "<$1$2")


def _head(role: Column) -> Column:
    for sign, code in _ROLE_SIGNS:
        role = F.replace(role, F.lit(sign), F.lit(code))
    return F.concat(F.lit("<turn "), role, F.lit(">\n"))


def _role(head: Column) -> Column:
    """The role out of a mark without its closing sign."""
    role = F.substr(head, F.lit(len("<turn ") + 1))
    for sign, code in reversed(_ROLE_SIGNS):
        role = F.replace(role, F.lit(code), F.lit(sign))
    return role


# ---- turns with their tokens and sums --------------------------------------------------------

_KEPT = ("conv_id", "piece", "head", "size", "target", "system")


def _counted(content):
    """Adds tokens, place and sums within the partition to rows sorted by conversation and turn.

    `run` numbers the conversations of the partition from 0; the one numbered 0 may have begun before it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from jobloom.llm.tokens import Encoder

        encoder, part, number = Encoder(content.value), TaskContext.get().partitionId(), 0
        run, last, place, start, opening = -1, None, 0, 0, 0
        for batch in batches:
            for rows in slices(batch, "piece"):
                _, bounds = encoder.encode(rows["piece"])
                tokens = (bounds[1:] - bounds[:-1]).tolist()
                out: dict[str, list] = {name: [] for name in ("number", "run", "place", "start", "opening")}
                for key, count, system in zip(rows["conv_id"].to_pylist(), tokens, rows["system"].to_pylist(), strict=True):
                    if run < 0 or key != last:
                        run, last, place, start, opening = run + 1, key, 0, 0, count if system else 0
                    for name, value in zip(out, (number, run, place, start, opening), strict=True):
                        out[name].append(value)
                    number, place, start = number + 1, place + 1, start + count
                columns = [rows[name] for name in _KEPT] + [pa.array(values, pa.int64()) for values in (tokens, *out.values())]
                names = [*_KEPT, "tokens", *out]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([part] * len(rows), pa.int32())], [*names, "part"])

    return run


def _carried(turns: DataFrame) -> DataFrame:
    """(part, turns, tokens and system tokens of its first conversation in earlier partitions): a row per partition at most."""
    end = F.max(F.struct("number", "conv_id", "run", (F.col("place") + 1).alias("turns"), (F.col("start") + F.col("tokens")).alias("tokens"), "opening"))
    ends = turns.groupBy("part").agg(F.min(F.struct("number", "conv_id")).alias("first"), end.alias("last")).orderBy("part").collect()
    rows, before = [], None
    for row in ends:
        first, last = row["first"], row["last"]
        count = tokens = opening = 0
        if before and before[0] == first["conv_id"]:
            _, count, tokens, opening = before
            rows.append((row["part"], count, tokens, opening))
        if last["run"]:
            count = tokens = 0
        own = opening if count else last["opening"]
        before = (last["conv_id"], count + last["turns"], tokens + last["tokens"], own)
    return turns.sparkSession.createDataFrame(rows, "part int, turns_before long, tokens_before long, opening_before long")


def _placed(turns: DataFrame, budget: int, history: int) -> DataFrame:
    """Turns with their place, first token (the system turn not counted) and room, in the whole conversation."""
    carried = (F.col("run") == 0) & F.col("turns_before").isNotNull()
    opening = F.when(carried, F.col("opening_before")).otherwise(F.col("opening"))
    opening = F.when(opening <= budget // 4, opening).otherwise(0)
    before = lambda name: F.when(carried, F.col(name)).otherwise(0)
    # As many rows as there are partitions.
    return turns.join(F.broadcast(_carried(turns)), "part", "left").select(
        "part", "conv_id", "piece", "head", "size", "target", "tokens",
        (F.col("place") + before("turns_before")).alias("place"),
        opening.alias("opening"),
        (F.col("start") + before("tokens_before") - opening).alias("start"),
        (F.lit(budget - history) - opening).alias("room"),
    )


def format_chats(
    turns: DataFrame, tokenizer: str, budget: int = BUDGET, history: int = HISTORY, system: str = SYSTEM, target: str = TARGET,
    conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """conv_id, window, formatted, loss (start and length in characters), n_turns, n_repeated, n_tokens.

    Windows of a conversation are in the order of `window`; their first `n_repeated` turns repeat
    earlier ones. `tokenizer` is a file that the driver reads.
    """
    if not 0 <= history <= budget // 2:
        raise ValueError("the repeated history takes at most half of the budget")
    spark = turns.sparkSession
    content = spark.sparkContext.broadcast(Path(tokenizer).read_text())
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    given = turns.select(
        F.col(conversation).alias("conv_id"), F.col(turn).alias("turn"), blank(role).alias("role"), blank(text).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    ).withColumn("body", escaped(F.col("text")))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_last(), F.col("role"), F.substring("text", 1, _TIE), F.xxhash64("text"), F.col("row")]
    sized = (
        given.repartitionByRange(*order).sortWithinPartitions(*order)
        .select(
            "conv_id", F.concat(_head(F.col("role")), "body", F.lit(TAIL)).alias("piece"), F.length(_head(F.col("role"))).alias("head"),
            F.length("body").alias("size"), (F.col("role") == target).alias("target"), (F.col("role") == system).alias("system"),
        )
    )
    kind = sized.schema["conv_id"].dataType.simpleString()
    shape = (
        f"conv_id {kind}, piece string, head int, size int, target boolean, system boolean,"
        " tokens long, number long, run long, place long, start long, opening long, part int"
    )
    path = shared_folder(spark, "turns")
    sized.mapInArrow(_counted(content), shape).write.parquet(path)
    placed = _placed(spark.read.parquet(path), budget, history)
    cells = placed.where((F.col("place") > 0) | (F.col("opening") == 0)).withColumns(
        {"cell": F.expr("start div room"), "end": F.col("start") + F.col("tokens")}
    ).withColumn("inside", F.expr("end <= (cell + 1) * room"))

    # Window 2c: the turns inside cell c; window 2c + 1: the turn across its end.
    near = history // 2
    own = F.struct((2 * F.col("cell") + F.when(F.col("inside"), 0).otherwise(1)).alias("window"), F.lit(False).alias("repeated"))
    again = lambda window: F.struct(F.expr(window).alias("window"), F.lit(True).alias("repeated"))
    late = F.col("inside") & F.expr(f"start >= (cell + 1) * room - {near}")
    short = ~F.col("inside") & (F.col("tokens") <= near)
    everywhere = F.when(late, F.array(own, again("2 * cell + 1"), again("2 * cell + 2"))).when(
        short, F.array(own, again("2 * ((end - 1) div room)"))
    ).otherwise(F.array(own))
    dealt = cells.select("part", "conv_id", "place", "piece", "head", "size", "target", "tokens", F.inline(everywhere))

    # The system turn goes to every window; the windows of a long conversation are listed per partition.
    listed = dealt.where(~F.col("repeated")).groupBy("part", F.col("conv_id").alias("id")).agg(F.collect_set("window").alias("windows"))
    first = listed.groupBy("id").agg(F.min(F.array_min("windows")).alias("first")).withColumnRenamed("id", "first_id")
    opened = placed.where((F.col("place") == 0) & (F.col("opening") > 0)).drop("part")
    opened = opened.join(first, F.col("conv_id").eqNullSafe(F.col("first_id")), "left")
    opened = opened.join(listed.drop("part"), F.col("conv_id").eqNullSafe(F.col("id")), "left")
    systems = opened.select(
        "conv_id", "place", "piece", "head", "size", "target", "tokens",
        F.explode(F.coalesce("windows", F.array(F.lit(0).cast("long")))).alias("window"), F.coalesce("first", F.lit(0)).alias("first"),
    ).withColumn("repeated", F.col("window") != F.col("first"))

    rows = dealt.drop("part").unionByName(systems.drop("first"))
    held = F.array_sort(F.collect_list(F.struct("place", "piece", "head", "size", "target", "repeated")))
    windows = rows.groupBy("conv_id", "window").agg(
        held.alias("turns"), F.count("*").cast("int").alias("n_turns"),
        F.count_if("repeated").cast("int").alias("n_repeated"), F.sum("tokens").alias("n_tokens"),
    )
    # Copies that no window waits for.
    windows = windows.where(F.col("n_turns") > F.col("n_repeated"))
    none = F.array().cast("array<struct<start:int,length:int>>")

    def step(state: Column, turn: Column) -> Column:
        span = F.struct((state["at"] + turn["head"]).cast("int").alias("start"), turn["size"].alias("length"))
        wanted = turn["target"] & ~turn["repeated"]
        return F.struct(
            (state["at"] + F.length(turn["piece"])).cast("int").alias("at"),
            F.when(wanted, F.array_append(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    spans = F.aggregate("turns", F.struct(F.lit(0).alias("at"), none.alias("spans")), step)["spans"]
    return windows.select(
        "conv_id", "window", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        spans.alias("loss"), "n_turns", "n_repeated", "n_tokens",
    )


# ---- reading back ----------------------------------------------------------------------------


def read_back(windows: DataFrame) -> DataFrame:
    """conv_id, window, turns (role and text of those that are not repeated) and learnt (texts under the mask), out of the formatted text."""
    marks = F.split("formatted", TAIL, -1)
    pieces = F.slice(marks, F.col("n_repeated") + 1, F.size(marks) - 1 - F.col("n_repeated"))

    def turn(piece: Column) -> Column:
        parts = F.split(piece, ">\n", 2)
        return F.struct(_role(parts[0]).alias("role"), unescaped(parts[1]).alias("text"))

    learnt = F.transform("loss", lambda s: unescaped(F.substr("formatted", s["start"] + 1, s["length"])))
    return windows.select("conv_id", "window", F.transform(pieces, turn).alias("turns"), learnt.alias("learnt"), "formatted")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations whose windows come in order, a window at a time."""
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    kind, key, counts, turns, loss = None, None, None, hashlib.sha256(), hashlib.sha256()

    def row() -> pa.RecordBatch:
        values = (key, counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2])
        kinds = (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], list(names))

    for batch in batches:
        kind, done = batch.schema.field("conv_id").type, []
        for name, n, spoken, learnt, loss_chars, chars in zip(*[batch[i].to_pylist() for i in range(6)], strict=True):
            if counts is None or name != key:
                if counts is not None:
                    done.append(row())
                key, counts, turns, loss = name, [0, 0, 0], hashlib.sha256(), hashlib.sha256()
            counts = [a + b for a, b in zip(counts, (n, loss_chars, chars), strict=True)]
            turns.update(spoken.encode())
            loss.update(learnt.encode())
        if done:
            yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
    if counts is not None:
        yield row()


def digests(windows: DataFrame) -> DataFrame:
    """What read-back windows hold, per conversation: turns, texts under the mask, and formatted characters.

    A digest runs through a conversation's texts in order, so one task streams them, a window at a time.
    """
    read = read_back(windows)
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join("learnt", "")
    rows = read.select(
        "conv_id", F.size("turns").alias("n"), spoken.alias("spoken"), learnt.alias("learnt"),
        F.length(learnt).alias("loss_chars"), F.length("formatted").alias("chars"), "window",
    )
    kind = rows.schema["conv_id"].dataType.simpleString()
    shape = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "window").mapInArrow(_digested, shape)

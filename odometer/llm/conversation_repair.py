"""Repair of conversation structure: cheapest edits, least audit among them.

A repaired conversation's role initials are ``(s?(ua)+)?``.  A node is a row to
come and what was said last (nothing, s, u or a); its arcs are the edits: Delete,
Keep and Rerole go on to the next row, Insert stays.  An edit's initial and its
node determine what is said next, so an audit (the edits' initials) fixes one
path.

Costs come first, by dynamic programming; the arcs of cheapest paths stay.  Their
nodes are then ranked by the least audits of length 1, 2, 4, ... that lead on
from them: a rank of length 2n is that of the pair (rank of length n here, rank
of length n at the node the pointer leads to), and pointers are doubled alike.
The least path takes at each node the arc with the least (initial, rank behind
it) and is read off through the doubled pointers.

Conversations are cut into stretches of rows.  A stretch is a 4 x 4 table of
costs between what was said before and after it; costs to the end come from
doubling these tables over neighbouring stretches, then every stretch ranks its
nodes for itself, and what was said before each stretch comes from doubling the
stretches' own ways.  So a conversation may be as long as the table: only the
digest of its repaired text is one chain, which its rows pass through in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odometer.llm.common import ordinals, ship, stash

#: Rows of one stretch.
STRETCH = 512

DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
NEVER = 1 << 60

#: What was said last: nothing, s, u, a; what an inserted or reroled row says.
START, SYSTEM, USER, ASSISTANT = range(4)
SAYS = [USER, USER, ASSISTANT, USER]
#: Costs from each state behind the last row: u and a are inserted as needed.
FINAL = [0, 2 * INSERT, INSERT, 0]
TAIL = ["", "ua", "a", ""]
#: After Keep, by state and initial; None: not allowed.
KEEPS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: Edits in the order of their initials.
EDITS = "DIKR"

#: Codes of rows in a stretch's word: d must go; else the role's initial (x: any
#: other), upper case where the text is truncated.
SPACES = " \t\n\x0b\x0c\r"


def row_arcs(code: str, state: int) -> list[tuple[int, int, int]]:
    """(edit, cost, state after it) of the edits that take a row."""
    arcs = [(0, DELETE, state)]
    if code != "d":
        more = TRUNCATED if code.isupper() else 0
        kept = KEEPS.get(code.lower(), {}).get(state)
        if kept is not None:
            arcs.append((2, more, kept))
        arcs.append((3, REROLE + more, SAYS[state]))
    return arcs


ARCS = {code: [row_arcs(code, state) for state in range(4)] for code in "dsuaxSUAX"}


def costs_before(codes: str, after: list[int]) -> list[list[int]]:
    """Cost from every node of a stretch to the end, by row and state, given
    the costs behind the stretch (the last entry)."""
    costs = [list(after)]
    for code in reversed(codes):
        behind = costs[-1]
        take = [min(cost + behind[to] for _, cost, to in arcs) for arcs in ARCS[code]]
        # Inserts lead from u to a and back; one each is enough.
        user, assistant = min(take[USER], INSERT + take[ASSISTANT]), min(take[ASSISTANT], INSERT + take[USER])
        costs.append([min(take[START], INSERT + user), min(take[SYSTEM], INSERT + user), user, assistant])
    costs.reverse()
    return costs


def transfer(codes: str) -> list[int]:
    """The 4 x 4 costs of a stretch, row by row: before x after."""
    columns = []
    for state in range(4):
        columns.append(costs_before(codes, [0 if s == state else NEVER for s in range(4)])[0])
    return [columns[after][before] for before in range(4) for after in range(4)]


def least_ways(codes: str, after: list[int]) -> list[tuple[int, str]]:
    """For each state before a stretch: the state after it and the moves of the
    least cheapest audit.  Moves: D, K, U or A (reroled to that), u or a
    (inserted)."""
    n = len(codes)
    costs = costs_before(codes, after)
    exits = 4 * n
    arcs: list[list[tuple[int, int]]] = []
    for row, code in enumerate(codes):
        here, behind = costs[row], costs[row + 1]
        for state in range(4):
            best = here[state]
            found = [(edit, 4 * (row + 1) + to) for edit, cost, to in ARCS[code][state] if cost + behind[to] == best]
            if INSERT + here[SAYS[state]] == best:
                found.append((1, 4 * row + SAYS[state]))
            arcs.append(sorted(found))
    # Length 1: the least initial, and where it leads; exits lead to themselves.
    rank = np.array([a[0][0] for a in arcs] + [len(EDITS)] * 4)
    to = np.array([a[0][1] for a in arcs] + [exits, exits + 1, exits + 2, exits + 3])
    pointers = [to]
    while (pointers[-1][:4] < exits).any():
        at = pointers[-1]
        _, rank = np.unique(rank * (4 * n + 5) + rank[at], return_inverse=True)
        pointers.append(at[at])
    # Ranks are final: each node's arc is the least by (initial, rank behind it).
    chosen = np.array([min(a, key=lambda arc: (arc[0], rank[arc[1]]))[0] for a in arcs])
    ways = []
    for state in range(4):
        path = np.array([state])
        for step in reversed(pointers[:-1] if len(pointers) > 1 else []):
            path = np.stack([path, step[path]], axis=1).ravel()
        path = path[path < exits]
        last = int(pointers[-1][state])
        moves = []
        for node in path.tolist():
            edit, says = chosen[node], "  ua"[SAYS[node % 4]]
            moves.append(says if edit == 1 else says.upper() if edit == 3 else "DIKR"[edit])
        ways.append((last - exits, "".join(moves)))
    return ways


def spoiled(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` (conv_id, turn, role, text) with planted
    damage, chosen by CRC-32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1
    empties its text, 2 removes the text's ``.!?``, 3 repeats the row, 4 makes
    its role user.  Nulls are one space, in conv_id and turn for the choice only."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = shown("text")
    rows = conversations.select(
        F.col("conv_id").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.when(kind == 4, "user").otherwise(shown("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        kind.alias("damage"),
    )
    copies = F.explode(F.when(F.col("damage") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.filter("damage != 0").select("conv_id", "turn", "role", "text", copies.alias("copy")).drop("copy")


def _in_order(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows numbered in order (conv, at, turn, initial, role, text), and of each
    its code and fault (conv, at, turn, fault, code).  Texts don't move for the
    second."""
    key = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("n"))
    keyed = rows.select(
        key.alias("conv"),
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
    )
    ending = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    keyed = keyed.select("*", ending.alias("ending"), F.substring("role", 1, 1).alias("initial"))
    told = ordinals(keyed, ["conv", "turn", "role", "text"], "at", "turns")
    # Of equal role and text the first row is no duplicate.  Joined by place, not
    # by text, so that a text said very often is no hot key.
    firsts = told.groupBy("conv", "role", F.sha2("text", 256).alias("said")).agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    marked = told.select("conv", "at", "turn", "initial", "ending").join(firsts, "at", "left")
    letter = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x")
    fault = (
        F.when(F.col("ending") == "", "blank")
        .when(F.col("first").isNull(), "duplicate")
        .when(~F.col("ending").isin(".", "!", "?"), "truncated")
    )
    code = F.when(F.col("fault").isin("blank", "duplicate"), "d").when(F.col("fault") == "truncated", F.upper(letter)).otherwise(letter)
    faults = marked.select("conv", "at", "turn", "initial", fault.alias("fault")).withColumn("code", code).drop("initial")
    return told.select("conv", "at", "turn", "initial", "role", "text"), faults


def _mapped(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInPandas`` over the columns of ``df``, a batch at a time.  Words are
    small for the work that they are, so their partitions stay as many as shuffles
    have."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    ship(df.sparkSession)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # By another key than joins use: a deal by the same one would be left out.
    return df.repartition(parts, F.xxhash64("conv", "stretch")).mapInPandas(run, schema)


def _times(left: Column, right: Column) -> Column:
    """The product of two 4 x 4 cost tables: least sums."""
    cell = [F.array_min(F.array(*[left[4 * i + k] + right[4 * k + j] for k in range(4)])) for i in range(4) for j in range(4)]
    # Kept from growing: no path is no path.
    return F.array(*[F.least(c, F.lit(NEVER)) for c in cell])


def _costs_after(tables: DataFrame, most: int) -> DataFrame:
    """For each stretch (conv, stretch, table): the costs behind it, from the
    product of all tables to its right, doubled over neighbours."""
    held, reach = tables.select("conv", "stretch", "table"), 1
    while reach < most:
        ahead = held.select("conv", (F.col("stretch") - reach).alias("stretch"), F.col("table").alias("ahead"))
        product = F.when(F.col("ahead").isNull(), F.col("table")).otherwise(_times(F.col("table"), F.col("ahead")))
        held = stash(held.join(ahead, ["conv", "stretch"], "left").select("conv", "stretch", product.alias("table")), "costs")
        reach *= 2
    total = F.array(*[F.array_min(F.array(*[F.col("table")[4 * i + j] + F.lit(FINAL[j]) for j in range(4)])) for i in range(4)])
    here = held.select("conv", "stretch", total.alias("total"))
    behind = here.select("conv", (F.col("stretch") - 1).alias("stretch"), F.col("total").alias("after"))
    return here.join(behind, ["conv", "stretch"], "left").select(
        "conv", "stretch", "total", F.coalesce("after", F.array(*map(F.lit, FINAL)).cast("array<long>")).alias("after"), F.col("after").isNull().alias("last")
    )


def _entries(ways: DataFrame, most: int) -> DataFrame:
    """For each stretch (conv, stretch, exits by state): the state before it,
    from the ways of all stretches to its left, doubled over neighbours."""
    held, reach = ways.select("conv", "stretch", F.col("exits").alias("way")), 1
    while reach < most:
        back = held.select("conv", (F.col("stretch") + reach).alias("stretch"), F.col("way").alias("back"))
        joined = F.when(F.col("back").isNull(), F.col("way")).otherwise(F.transform("back", lambda s: F.element_at("way", s + 1)))
        held = stash(held.join(back, ["conv", "stretch"], "left").select("conv", "stretch", joined.alias("way")), "entries")
        reach *= 2
    before = held.select("conv", (F.col("stretch") + 1).alias("stretch"), F.element_at("way", START + 1).alias("entry"))
    return ways.join(before, ["conv", "stretch"], "left").withColumn("entry", F.coalesce("entry", F.lit(START)))


def _moves(rows: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Moves by stretch (conv, stretch, first, moves), and total costs (conv, cost)."""
    stretch = F.floor(F.col("at") / length)
    words = rows.groupBy("conv", stretch.alias("stretch")).agg(
        F.min("at").alias("first"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "code"))), lambda r: r["code"]), "").alias("word")
    )
    words = stash(words, "words")

    def costs(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"conv": batch["conv"], "stretch": batch["stretch"], "table": [transfer(w) for w in batch["word"]]})

    def ways(batch: pd.DataFrame) -> pd.DataFrame:
        found = [least_ways(w, list(after)) for w, after in zip(batch["word"], batch["after"])]
        out = batch[["conv", "stretch", "first"]].copy()
        out["exits"] = [[state for state, _ in way] for way in found]
        out["moves"] = [[moves + (TAIL[state] if last else "") for state, moves in way] for way, last in zip(found, batch["last"])]
        return out

    (most,) = words.groupBy("conv").agg((F.max("stretch") - F.min("stretch") + 1).alias("n")).agg(F.max("n")).first()
    tables = stash(_mapped(words.select("conv", "stretch", "word"), costs, "conv string, stretch long, table array<long>"), "tables")
    after = _costs_after(tables, most or 0)
    judged = words.join(after, ["conv", "stretch"])
    found = _mapped(
        judged.select("conv", "stretch", "first", "word", "after", "last"),
        ways,
        "conv string, stretch long, first long, exits array<int>, moves array<string>",
    )
    found = _entries(stash(found, "ways"), most or 0)
    heads = words.groupBy("conv").agg(F.min("stretch").alias("stretch"))
    cost = after.join(heads, ["conv", "stretch"]).select("conv", F.col("total")[START].alias("cost"))
    return found.select("conv", "stretch", "first", F.element_at("moves", F.col("entry") + 1).alias("moves")), cost


def _edits(moves: DataFrame) -> DataFrame:
    """Per row (conv, at) its edit: the inserts before it, its own move and, at
    a conversation's end, the inserts behind it."""
    each = F.posexplode(F.regexp_extract_all("moves", F.lit("[ua]*[DKUA](?:[ua]+$)?"), F.lit(0))).alias("n", "edit")
    each = moves.select("conv", "first", each)
    return each.select("conv", (F.col("first") + F.col("n")).alias("at"), "edit")


def _lines(rows: DataFrame) -> Column:
    """The repaired lines that a row gives, each with a newline behind it."""
    own = F.regexp_extract("edit", "[DKUA]", 0)

    def inserted(part: Column) -> Column:
        return F.replace(F.replace(F.replace(part, F.lit("a"), F.lit("\x01")), F.lit("u"), F.lit("user:\n")), F.lit("\x01"), F.lit("assistant:\n"))

    role = F.when(own == "U", "user").when(own == "A", "assistant").otherwise(F.col("role"))
    line = F.when(own == "D", "").otherwise(F.concat(role, F.lit(":"), F.col("text"), F.lit("\n")))
    return F.concat(inserted(F.regexp_extract("edit", "^[ua]*", 0)), line, inserted(F.regexp_extract("edit", "[ua]*$", 0)))


LEGAL = {"su", "ua", "au"}


SAID = {"u": "user", "a": "assistant", "U": "user", "A": "assistant"}


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations whose sorted rows stream by, each behind its edit, in
    constant memory but for the audit: conv, audit, illegal, repaired_sha256."""
    conv, audit, illegal, state, said, last, edit = None, [], 0, None, False, None, ""
    done: list[tuple] = []

    def finished() -> tuple:
        return (conv, "".join(audit).translate(str.maketrans("uaUA", "IIRR")), illegal, state.hexdigest())

    for batch in batches:
        for row_conv, row_edit, initial, role, text in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if row_conv != conv:
                if conv is not None:
                    done.append(finished())
                conv, audit, illegal, state, said, last = row_conv, [], 0, hashlib.sha256(), False, None
            if row_edit is not None:
                edit = row_edit
                continue
            if last is not None and last + initial not in LEGAL:
                illegal += 1
            last = initial
            audit.append(edit)
            for move in edit:
                if move == "D":
                    continue
                line = f"{SAID.get(move, role)}:{'' if move in 'ua' else text}"
                state.update(("\n" + line if said else line).encode())
                said = True
        yield _told_batch(done)
        done = []
    if conv is not None:
        yield _told_batch([finished()])


def _told_batch(done: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*done)) or [(), (), (), ()]
    kinds = (pa.string(), pa.string(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["conv", "audit", "illegal", "repaired_sha256"])


def repaired_rows(rows: DataFrame, length: int = STRETCH) -> DataFrame:
    """The rows of the repaired conversations: conv_id as text, at (their order), line
    (``role:text``, several where rows are inserted beside it), edit."""
    told, faults = _in_order(rows)
    moves, _ = _moves(stash(faults, "faults"), length)
    edited = told.join(_edits(moves).drop("conv"), "at")
    return edited.select(F.when(F.col("conv") != "n", F.expr("substring(conv, 2)")).alias("conv_id"), "at", _lines(edited).alias("lines"), "edit")


def repair(original: DataFrame, rows: DataFrame, length: int = STRETCH) -> DataFrame:
    """One row per conv_id of ``original``: gaps, blank, duplicate, truncated,
    illegal, cost, audit and repaired_sha256 of its rows in ``rows`` (conv_id,
    turn, role, text).

    Rows are taken by turn (nulls first), then by role and text.  A null role or
    text is one space, the null conv_id a conversation like any other.  Roles
    other than system, user and assistant count by their initial.  Repeated rows
    are duplicates after the first.  A conversation without rows has zeros, an empty
    audit and the hash of the empty string.  An empty table gives no rows; other
    columns are ignored.  ``length`` rows are worked on in one piece; the result
    doesn't depend on it.
    """
    told, faults = _in_order(rows)
    faults = stash(faults, "faults")
    moves, cost = _moves(faults, length)
    # Rows and their edits meet in the one shuffle that brings conversations
    # together, each edit before its row.
    rows_out = told.select("conv", "at", F.lit(None).cast("string").alias("edit"), "initial", "role", "text")
    nothing = [F.lit(None).cast("string").alias(c) for c in ("initial", "role", "text")]
    both = rows_out.unionByName(_edits(moves).select("conv", "at", "edit", *nothing))
    ship(original.sparkSession)
    dealt = both.repartition("conv").sortWithinPartitions("conv", "at", F.col("edit").isNull())
    streamed = dealt.select("conv", "edit", "initial", "role", "text")
    told = streamed.mapInArrow(_told, "conv string, audit string, illegal long, repaired_sha256 string")
    turns = faults.filter("turn IS NOT NULL").groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).cast("long").alias("gaps")
    )
    kinds = ["blank", "duplicate", "truncated"]
    counts = faults.groupBy("conv").agg(*[F.count(F.when(F.col("fault") == k, 1)).alias(k) for k in kinds])
    key = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("n"))
    out = original.select(F.col("conv_id").alias("conv_id")).distinct().withColumn("conv", key)
    for part in (turns, counts, cost, told):
        out = out.join(part, "conv", "left")
    nothing = hashlib.sha256().hexdigest()
    zeros = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", *kinds, "illegal", "cost")]
    return out.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))

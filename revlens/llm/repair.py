"""Conversation structure repair: cheapest edits by dynamic programming over grammar-compressed turns."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import Memo, staged

#: Copies of one row that a piece stands for, and pieces of a conversation that make a chunk.
PIECE, CHUNK = 64, 1024
#: Rules of the grammar and how many a round adds. A pair without a rule stays as it is.
RULES, ROUND = 512, 64

# Costs, and the white space and ends of sentences that the faults speak of.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
_WHITE = " \t\n\x0b\f\r"
_ENDS = (".", "!", "?")
_LEGAL = {(0, 1), (1, 2), (2, 1)}  # su, ua, au

#: A rope: a short text, or two ropes one after the other. A cell: cost and audit, or no way.
Rope = str | tuple
Cell = tuple[int, Rope] | None
Matrix = list[list[Cell]]
#: First and last role, illegal neighbours, blank, duplicate and truncated rows.
Summary = tuple[int, int, int, int, int, int]

_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_STEP = {(_START, 0): _SYSTEM, (_START, 1): _USER, (_SYSTEM, 1): _USER, (_ASSISTANT, 1): _USER, (_USER, 2): _ASSISTANT}
#: What insertions alone reach; going round in a circle only costs.
_INSERTED = {
    _START: [(_START, 0), (_USER, 1), (_ASSISTANT, 2)],
    _SYSTEM: [(_SYSTEM, 0), (_USER, 1), (_ASSISTANT, 2)],
    _USER: [(_USER, 0), (_ASSISTANT, 1)],
    _ASSISTANT: [(_ASSISTANT, 0), (_USER, 1)],
}


def damaged(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv``, ``turn``, ``role``, ``text`` of rows damaged by ``crc32(conv:turn) % 20``: 0 drops the
    row, 1 empties its text, 2 removes its ``[.!?]``, 3 repeats it, 4 makes it the user's.

    NULL roles and texts become one space, and so do NULL conversations and turns in the number's text;
    both stay NULL as columns. Repeated rows are damaged alike. No rows, no rows.
    """

    def filled(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(filled(conv_col), F.lit(":"), filled(turn_col)).cast("binary")) % 20
    rows = conversations.select(
        F.col(f"`{conv_col}`").alias("conv"),
        F.col(f"`{turn_col}`").cast("long").alias("turn"),
        filled(role_col).alias("role"),
        filled(text_col).alias("text"),
        kind.alias("kind"),
    ).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", "".join(_ENDS), "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copies")
    ).select("conv", "turn", "role", "text", F.explode("copies").alias("copy")).drop("copy")


def _placed(turns: DataFrame) -> DataFrame:
    """Columns that order a conversation's rows: by turn, NULL first; then role, then the text's digest."""
    return turns.withColumns({"placed": F.col("turn").isNotNull(), "digest": F.md5("text")})


_ORDER = ("placed", "turn", "role", "digest")


def _letter(fault: Column) -> Column:
    """One letter for role (s, u, a, other) and fault (none, blank, duplicate, truncated)."""
    first = F.substring("role", 1, 1)
    role = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    return F.char(F.lit(65) + role * 4 + fault)


def _distinct_turns(turns: DataFrame) -> DataFrame:
    """Rows alike in all columns as one row with their number ``n``; texts as digests. Written aside."""
    bare = F.rtrim(F.col("text"), F.lit(_WHITE))
    rows = _placed(turns).select(
        "conv", *_ORDER, (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(*_ENDS)).alias("cut")
    )
    rows = rows.groupBy("conv", *_ORDER).agg(F.count(F.lit(1)).alias("n"), F.min("blank").alias("blank"), F.min("cut").alias("cut"))
    return staged(rows, "repair-turns")


def _chunks(distinct: DataFrame) -> DataFrame:
    """``conv``, ``block``, ``marks``: every conversation's symbols in order, at most ``CHUNK`` pieces a row.

    All rows are dealt out by range over conversation, turn, role, digest and piece, no two of which
    are alike, so the rows of one long conversation, one turn or one repeated row are many tasks.
    """
    firsts = distinct.groupBy("conv", "role", "digest").agg(F.min(F.struct("placed", "turn")).alias("first"))
    firsts = firsts.select(
        F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"),
        F.col("first.placed").alias("p"), F.col("first.turn").alias("t"),
    )
    same = (
        F.col("conv").eqNullSafe(F.col("c"))
        & (F.col("role") == F.col("r"))
        & (F.col("digest") == F.col("d"))
        & (F.col("placed") == F.col("p"))
        & F.col("turn").eqNullSafe(F.col("t"))
    )
    rows = distinct.join(firsts, same, "left")
    fault = F.when(F.col("blank"), 1).when(F.col("p").isNull(), 2).when(F.col("cut"), 3).otherwise(0)
    more = F.when(F.col("blank"), 1).otherwise(2)
    rows = rows.select("conv", *_ORDER, "n", _letter(fault).alias("one"), _letter(more).alias("rest"))
    rows = rows.withColumn("piece", F.explode(F.sequence(F.lit(0), ((F.col("n") - 1) / PIECE).cast("long"))))
    here = F.least(F.col("n") - F.col("piece") * PIECE, F.lit(PIECE)).cast("int")
    marks = F.when(F.col("piece") == 0, F.concat("one", F.repeat(F.col("rest"), here - 1))).otherwise(F.repeat(F.col("rest"), here))
    rows = rows.withColumn("marks", marks)
    rows = rows.repartitionByRange("conv", *_ORDER, "piece").sortWithinPartitions("conv", *_ORDER, "piece")
    rows = rows.select("conv", "marks", F.monotonically_increasing_id().alias("at"))
    rows = rows.withColumn("block", F.floor(F.col("at") / CHUNK)).groupBy("conv", "block")
    parts = F.transform(F.array_sort(F.collect_list(F.struct("at", "marks"))), lambda x: x["marks"])
    return staged(rows.agg(F.array_join(parts, "").alias("marks")), "repair-chunks")


# ---- grammar --------------------------------------------------------------------------------

#: Rounds of rules: pairs of symbols, the new symbol of each being its place after the 16 letters.
Grammar = list[dict[tuple[int, int], int]]


def _replaced(symbols: list[int], rules: dict[tuple[int, int], int]) -> list[int]:
    """Pairs with a rule as its symbol: the earlier rule first, then from left to right."""
    found = sorted((rules[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in rules)
    if not found:
        return symbols
    new: dict[int, int] = {}
    taken = bytearray(len(symbols) + 1)
    for symbol, i in found:
        if not taken[i] and not taken[i + 1]:
            taken[i] = taken[i + 1] = 1
            new[i] = symbol
    out, i = [], 0
    while i < len(symbols):
        out.append(new.get(i, symbols[i]))
        i += 2 if i in new else 1
    return out


def compressed(marks: str, grammar: Grammar) -> list[int]:
    symbols = [ord(c) - 65 for c in marks]
    for rules in grammar:
        symbols = _replaced(symbols, rules)
    return symbols


def learn_grammar(sequences: DataFrame, most: int = RULES, a_round: int = ROUND) -> Grammar:
    """Re-Pair over ``marks`` with their number ``n``: the most frequent pairs become symbols, round by round.

    Pairs are counted over all sequences: in the tasks first, then by one grouping. A round adds the
    ``a_round`` most frequent pairs that stand at two places or more; no more than ``most`` rules are
    made, which bounds what the driver and the tasks hold. Results do not depend on the grammar.
    """
    grammar: Grammar = []
    made = 0
    while made < most:

        def count(batches: Iterable[pa.RecordBatch], grammar: Grammar = grammar) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                pairs: Counter[tuple[int, int]] = Counter()
                for marks, n in zip(batch.column("marks").to_pylist(), batch.column("n").to_pylist()):
                    symbols, last = compressed(marks, grammar), -2
                    for i, pair in enumerate(zip(symbols, symbols[1:])):
                        if pair[0] == pair[1] and last == i - 1 and symbols[last] == pair[0]:
                            continue  # the second place of a run overlaps the first
                        last = i if pair[0] == pair[1] else -2
                        pairs[pair] += n
                rows = [(a, b, n) for (a, b), n in pairs.items()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], names=["a", "b", "n"]
                )

        best = (
            sequences.mapInArrow(count, "a long, b long, n long")
            .groupBy("a", "b")
            .agg(F.sum("n").alias("n"))
            .where("n >= 2")
            .orderBy(F.desc("n"), "a", "b")
            .limit(min(a_round, most - made))
            .collect()
        )
        if not best:
            break
        grammar = [*grammar, {(r.a, r.b): 16 + made + i for i, r in enumerate(best)}]
        made += len(best)
    return grammar


# ---- transfer matrices ----------------------------------------------------------------------


def _joined(a: Rope, b: Rope) -> Rope:
    if not a or not b:
        return a or b
    return a + b if isinstance(a, str) and isinstance(b, str) and len(a) + len(b) <= 48 else (a, b)


def leaves(rope: Rope) -> Iterator[str]:
    waiting = [rope]
    while waiting:
        top = waiting.pop()
        if isinstance(top, str):
            yield top
        else:
            waiting += (top[1], top[0])


def _less(a: Rope, b: Rope) -> bool:
    if a is b:
        return False
    ours, theirs = leaves(a), leaves(b)
    s = t = ""
    while True:
        s, t = s or next(ours, ""), t or next(theirs, "")
        if not s or not t:
            return bool(t)
        n = min(len(s), len(t))
        if s[:n] != t[:n]:
            return s[:n] < t[:n]
        s, t = s[n:], t[n:]


def _better(a: Cell, b: Cell) -> bool:
    """Costs less than ``b``, or as much with a smaller audit."""
    return a is not None and (b is None or a[0] < b[0] or (a[0] == b[0] and _less(a[1], b[1])))


def _terminal(symbol: int) -> Matrix:
    """Cheapest way from state to state over one row: insertions before it, then its edit."""
    role, fault = divmod(symbol, 4)
    matrix: Matrix = [[None] * 4 for _ in range(4)]
    for state in range(4):
        for at, inserted in _INSERTED[state]:
            ways = [(at, DELETE, "D")]
            if fault in (0, 3):
                extra = TRUNCATED if fault == 3 else 0
                ways += [(_STEP.get((at, role)), extra, "K")]
                ways += [(_STEP.get((at, new)), extra + REROLE, "R") for new in (1, 2)]
            for to, cost, name in ways:
                cell = (inserted * INSERT + cost, "I" * inserted + name)
                if to is not None and _better(cell, matrix[state][to]):
                    matrix[state][to] = cell
    return matrix


def _product(row: list[Cell], matrix: Matrix) -> tuple[list[Cell], list[int]]:
    """Min-plus product of a row with a matrix, and the state each best way comes through."""
    out: list[Cell] = [None] * 4
    through = [-1] * 4
    for k, head in enumerate(row):
        if head is None:
            continue
        for j, tail in enumerate(matrix[k]):
            if tail is None or (out[j] is not None and out[j][0] < head[0] + tail[0]):
                continue
            cell = (head[0] + tail[0], _joined(head[1], tail[1]))
            if _better(cell, out[j]):
                out[j], through[j] = cell, k
    return out, through


def _summary(symbol: int) -> Summary:
    role, fault = divmod(symbol, 4)
    return role, role, 0, int(fault == 1), int(fault == 2), int(fault == 3)


def _added(a: Summary | None, b: Summary) -> Summary:
    if a is None:
        return b
    illegal = a[2] + b[2] + ((a[1], b[0]) not in _LEGAL)
    return a[0], b[1], illegal, a[3] + b[3], a[4] + b[4], a[5] + b[5]


def evaluated(grammar: Grammar) -> tuple[list[Matrix], list[Summary]]:
    """Matrix and summary of every symbol, bottom-up: a rule's is the product of its two parts'."""
    matrices = [_terminal(s) for s in range(16)]
    summaries = [_summary(s) for s in range(16)]
    for rules in grammar:
        for a, b in rules:
            matrices.append([_product(row, matrices[b])[0] for row in matrices[a]])
            summaries.append(_added(summaries[a], summaries[b]))
    return matrices, summaries


class _Way:
    """Cheapest ways over the symbols so far, from the start to every state.

    What all of them have in common is set aside as soon as they come through one state, so that only
    their ends are compared.
    """

    def __init__(self) -> None:
        self.common: list[Rope] = []
        self.cost = 0
        self.row: list[Cell] = [(0, ""), None, None, None]
        self.summary: Summary | None = None

    def copy(self) -> _Way:
        other = _Way()
        other.common, other.cost, other.row, other.summary = [*self.common], self.cost, [*self.row], self.summary
        return other

    def go(self, symbols: list[int], matrices: list[Matrix], summaries: list[Summary]) -> _Way:
        for symbol in symbols:
            row, through = _product(self.row, matrices[symbol])
            came = {k for k in through if k >= 0}
            if len(came) == 1:
                only = came.pop()
                cost, audit = self.row[only]
                self.common.append(audit)
                self.cost += cost
                self.row = matrices[symbol][only]
            else:
                self.row = row
            self.summary = _added(self.summary, summaries[symbol])
        return self

    def end(self) -> tuple[int, str]:
        """Cost and audit of the cheapest way that ends after an assistant's turn, or without turns."""
        best: Cell = None
        for cell, more in zip(self.row, (0, 2, 1, 0)):
            if cell is not None:
                last = (cell[0] + more * INSERT, _joined(cell[1], "I" * more))
                best = last if _better(last, best) else best
        return self.cost + best[0], "".join(s for rope in [*self.common, best[1]] for s in leaves(rope))


_PLAN = "blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _in_bulk(rows: Iterable[tuple], schema: pa.Schema, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    full = 0
    for row in rows:
        held.append(row)
        full += 64 + sum(len(x) for x in row if isinstance(x, str))
        if full >= size:
            yield _batch(schema, held)
            held, full = [], 0
    if held:
        yield _batch(schema, held)


def _arrow_type(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)


def plans(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns`` (``conv``, ``turn``, ``role``, ``text``, the last two not NULL):
    faults, neighbours of illegal roles, cost and audit of the cheapest repair.

    Rows stand by turn, NULL turns first, rows of one turn by role and the digest of the text; rows
    alike in all four are copies, all but the first of them duplicates. A NULL conversation is one
    conversation. A role is known by its first letter; roles that begin otherwise, empty ones too,
    must be changed or deleted. Texts of any length only enter as their digests. No rows, no plans.

    Method: symbols of role and fault in order, cut into chunks; a Re-Pair grammar over all distinct
    chunks; one min-plus matrix with an audit rope per rule, made once, bottom-up, and shared by all
    conversations; a conversation is the product over its compressed chunks, read as a stream.
    """
    return _plans(_distinct_turns(turns))


def _plans(distinct: DataFrame) -> DataFrame:
    chunks = _chunks(distinct)
    sequences = staged(chunks.groupBy("marks").agg(F.count(F.lit(1)).alias("n")), "repair-sequences")
    grammar = learn_grammar(sequences)
    matrices, summaries = evaluated(grammar)
    conv_type = _arrow_type(distinct, "conv")

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun = Memo(lambda marks: _Way().go(compressed(marks, grammar), matrices, summaries), 20_000)

        def rows() -> Iterator[tuple]:
            way: _Way | None = None
            conv = None
            for batch in batches:
                for c, marks in zip(batch.column("conv").to_pylist(), batch.column("marks").to_pylist()):
                    if way is not None and c == conv:
                        way.go(compressed(marks, grammar), matrices, summaries)
                        continue
                    if way is not None:
                        yield _planned(conv, way)
                    conv, way = c, begun[marks].copy()
            if way is not None:
                yield _planned(conv, way)

        names = ["conv", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
        types = [conv_type, *[pa.int64()] * 5, pa.string()]
        yield from _in_bulk(rows(), pa.schema(list(zip(names, types))))

    conv = f"conv {distinct.schema['conv'].dataType.simpleString()}"
    ordered = chunks.repartition("conv").sortWithinPartitions("conv", "block").select("conv", "marks")
    return ordered.mapInArrow(fold, f"{conv}, {_PLAN}")


def _planned(conv: object, way: _Way) -> tuple:
    _, _, illegal, blank, duplicate, truncated = way.summary
    return (conv, blank, duplicate, truncated, illegal, *way.end())


# ---- repaired turns -------------------------------------------------------------------------


def _with_audits(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows in order."""
    none = {c: F.lit(None).cast(t) for c, t in (("placed", "boolean"), ("turn", "long"), ("role", "string"), ("digest", "string"), ("text", "string"))}
    heads = audits.select("conv", F.lit(0).alias("part"), "audit", *[v.alias(k) for k, v in none.items()])
    body = _placed(turns).select("conv", F.lit(1).alias("part"), F.lit(None).cast("string").alias("audit"), *none)
    rows = heads.unionByName(body).repartition("conv").sortWithinPartitions("conv", "part", *_ORDER)
    return rows.select("conv", "part", "audit", "role", "text")


def _edited(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """(conversation, None) where one begins, then (conversation, (edit, role, text)) in order; deleted rows too."""
    conv: object = None
    audit, at, role_of_last = "", 0, ""

    def role_next() -> str:
        return "assistant" if role_of_last == "u" else "user"

    def insertions() -> Iterator[tuple]:
        nonlocal at, role_of_last
        while at < len(audit) and audit[at] == "I":
            role = role_next()
            role_of_last = role[0]
            at += 1
            yield conv, ("I", role, "")

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv", "part", "audit", "role", "text")]
        for c, part, new, role, text in zip(*columns):
            if part == 0:
                yield from insertions()  # those at the end of the conversation before
                conv, audit, at, role_of_last = c, new, 0, ""
                yield conv, None
                continue
            yield from insertions()
            edit = audit[at]
            at += 1
            if edit == "R":
                role = role_next()
            if edit != "D":
                role_of_last = role[:1]
            yield conv, (edit, role, text)
    yield from insertions()


def repaired_turns(turns: DataFrame, planned: DataFrame) -> DataFrame:
    """``conv``, ``place`` (from 0), ``edit`` (K, R or I), ``role``, ``text`` of the repaired conversations.

    ``planned`` has ``conv`` and ``audit`` as ``plans`` makes them of the same turns. Each conversation
    is read as a stream by one task, whatever its length; texts are held one batch at a time.
    """
    conv_type = _arrow_type(turns, "conv")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            place = 0
            for conv, edit in _edited(batches):
                if edit is None:
                    place = 0
                elif edit[0] != "D":
                    yield (conv, place, *edit)
                    place += 1

        names = ["conv", "place", "edit", "role", "text"]
        types = [conv_type, pa.int64(), *[pa.string()] * 3]
        yield from _in_bulk(rows(), pa.schema(list(zip(names, types))))

    conv = f"conv {turns.schema['conv'].dataType.simpleString()}"
    return _with_audits(turns, planned).mapInArrow(run, f"{conv}, place long, edit string, role string, text string")


def repaired_digests(turns: DataFrame, planned: DataFrame) -> DataFrame:
    """``conv``, ``repaired_sha256`` for every row of ``planned``: of the repaired ``role:text`` joined by newlines.

    A digest is made in the rows' order, so one task reads a conversation, as a stream.
    """
    conv_type = _arrow_type(turns, "conv")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            state = None
            empty, of = True, None
            for conv, edit in _edited(batches):
                if edit is None:
                    if state is not None:
                        yield of, state.hexdigest()
                    state, empty, of = hashlib.sha256(), True, conv
                elif edit[0] != "D":
                    state.update(("" if empty else "\n").encode() + f"{edit[1]}:{edit[2]}".encode())
                    empty = False
            if state is not None:
                yield of, state.hexdigest()

        yield from _in_bulk(rows(), pa.schema([("conv", conv_type), ("repaired_sha256", pa.string())]))

    conv = f"conv {turns.schema['conv'].dataType.simpleString()}"
    return _with_audits(turns, planned).mapInArrow(run, f"{conv}, repaired_sha256 string")


def repair_report(turns: DataFrame, conversations: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """For every conversation named in ``conversations``: gaps in its turns, faults, cost, audit and
    digest of the repaired rows.

    Gaps are turn numbers missing between the smallest and the largest of ``turns``, NULL turns left
    out. Conversations without rows in ``turns`` have zeros, an empty audit and the empty text's digest.
    """
    turns = staged(turns, "repair-damaged")
    distinct = _distinct_turns(turns)
    gaps = (
        distinct.groupBy("conv", "turn").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("conv")
        .agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    )
    named = conversations.select(F.col(f"`{conv_col}`").alias("conv")).distinct()
    rows = named
    for i, part in enumerate((gaps, _plans(distinct))):
        part = part.withColumnRenamed("conv", f"c{i}")
        rows = rows.join(part, F.col("conv").eqNullSafe(F.col(f"c{i}")), "left").drop(f"c{i}")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    rows = staged(
        rows.select("conv", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers], F.coalesce("audit", F.lit("")).alias("audit")),
        "repair-plans",
    )
    digests = repaired_digests(turns, rows).withColumnRenamed("conv", "c")
    return rows.join(digests, F.col("conv").eqNullSafe(F.col("c")), "left").drop("c")

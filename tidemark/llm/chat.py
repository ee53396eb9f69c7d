"""Chat formatting in budgeted windows, with Spark's own functions only.

A conversation becomes one or more windows of whole turns. Prefix sums of the turns' tokens say where
windows start: room for new turns is what the budget leaves beside the system turn and the repeated
history, and a cell is half of it. Turns that start in the same cell form a window; a turn of more than
a cell has a window of its own. So every window keeps within the budget, unless one turn alone exceeds
it (turns are never cut), or the system turn takes more than half of it.

Each window repeats, before its own turns, the system turn (the conversation's first one, in all windows
after its own) and the last turns before it, as far as the budget, ``history_tokens`` and
``history_turns`` allow. The loss mask holds the texts of assistant turns in the window they belong to,
never repeated ones: over all windows each assistant text is masked in exactly once.

No conversation has to fit in one task: rows are dealt out by conversation and block of turn numbers,
windows end with the block, and what a block repeats from before it is sent along (its system turn and
the last ``history_turns`` turn numbers). Texts are shuffled once.

Template: ``<|start|>role<|message|>text<|end|>`` and a line feed. In roles and texts ``\\`` is written
as ``\\\\`` and ``<|`` as ``<\\|``, so no mark can occur inside them, and both read back exactly.

Null texts and roles count as empty. Rows without a turn number come first; equal turn numbers (repeated
rows too: each is a turn) are ordered by role and text and stay together. Rows without a conversation id
form one conversation. Other columns are ignored, whatever their names. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The template.
START, MESSAGE, END = "<|start|>", "<|message|>", "<|end|>\n"

BUDGET = 2048
HISTORY_TOKENS = 256
HISTORY_TURNS = 4
BLOCK_TURNS = 256
TURN_TOKENS = 4  # what the template's marks and the role take
CHARS_PER_TOKEN = 4
FIRST_BLOCK = -(1 << 62)  # of rows without a turn number


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(START), escaped(turn["role"]), F.lit(MESSAGE), escaped(turn["text"]), F.lit(END))


def read_back(text: Column) -> Column:
    """The turns of a formatted text: an array of (role, text), unescaped."""
    pieces = F.split(text, r"<\|end\|>\n")
    whole = F.slice(pieces, 1, F.size(pieces) - 1)
    one = lambda p: F.split(F.substring(p, len(START) + 1, 1 << 30), r"<\|message\|>")
    return F.transform(whole, lambda p: F.struct(unescaped(one(p)[0]).alias("role"), unescaped(one(p)[1]).alias("text")))


def under_mask(text: Column, loss: Column) -> Column:
    """The texts under the loss mask, unescaped."""
    return F.transform(loss, lambda s: unescaped(F.substring(text, s["start"] + 1, s["end"] - s["start"])))


def _spans(turns: Column, head: Column) -> Column:
    """Code points (start, end) of the texts to learn, in the order of ``turns``; ``head`` is what stands before."""
    zero = F.struct(head.cast("int").alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("found"))

    def step(state: Column, t: Column) -> Column:
        begin = state["at"] + F.char_length(escaped(t["role"])) + (len(START) + len(MESSAGE))
        end = begin + F.char_length(escaped(t["text"]))
        own = F.array(F.struct(begin.alias("start"), end.alias("end")))
        learn = (t["kind"] == 1) & (t["role"] == "assistant")
        return F.struct((end + len(END)).alias("at"), F.when(learn, F.concat(state["found"], own)).otherwise(state["found"]).alias("found"))

    return F.aggregate(turns, zero, step, lambda s: s["found"])


def _dealt(rows: DataFrame, block_turns: int, history_turns: int) -> DataFrame:
    """Every row with its block (kind 1), the last ones of each block also for the next (kind 0), and
    the system turn for all later blocks of its conversation (kind -1)."""
    block = F.expr(f"(turn - pmod(turn, {block_turns})) div {block_turns}")
    rows = rows.withColumn("block", F.coalesce(block, F.lit(FIRST_BLOCK)))
    last = F.pmod("turn", F.lit(block_turns)) >= block_turns - history_turns
    lead = rows.filter(last).withColumn("block", F.col("block") + 1)
    # Most conversations have one block: only the others' system turns are joined.
    system = rows.filter(F.col("role") == "system").groupBy("conv").agg(F.min(F.struct("turn", "role", "text", "cost", "block")).alias("s"))
    blocks = rows.select("conv", "block").distinct()
    more = blocks.groupBy(F.col("conv").alias("long")).agg(F.min("block").alias("low"), F.max("block").alias("high")).filter("low < high")
    system = system.join(more, F.col("conv").eqNullSafe(F.col("long"))).select("conv", "s")
    later = blocks.select(F.col("conv").alias("of"), "block")
    heads = system.join(later, F.col("conv").eqNullSafe(F.col("of"))).filter("s.block < block")
    heads = heads.select("conv", "s.turn", "s.role", "s.text", "s.cost", "block")
    kinds = ((rows, 1), (lead, 0), (heads, -1))
    all_, *rest = (df.select("conv", "block", F.lit(kind).alias("kind"), "turn", "role", "text", "cost") for df, kind in kinds)
    for df in rest:
        all_ = all_.union(df)
    return all_


def windows(
    rows: DataFrame,
    budget: int = BUDGET,
    history_tokens: int = HISTORY_TOKENS,
    history_turns: int = HISTORY_TURNS,
    block_turns: int = BLOCK_TURNS,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    tokens: str | None = None,
) -> DataFrame:
    """The windows of all conversations: one row (conv_id, block, window, n_tokens, n_repeated, text, loss) each.

    Windows of a conversation are in the order of (block, window). ``n_repeated`` is the number of
    leading turns that are repeats; ``loss`` has the spans (start, end exclusive, in code points) of
    ``text`` to learn. ``tokens`` names a column with the turns' token counts; without it a turn counts a
    token for every four bytes, rounded up. Each turn takes TURN_TOKENS more.
    """
    if not (0 <= history_tokens <= budget // 4 and budget >= 16 and 0 <= history_turns < block_turns):
        raise ValueError("history takes a quarter of the budget at most, and fewer turns than a block")
    name = lambda c: F.col(f"`{c}`")
    body = F.coalesce(name(text).cast("string"), F.lit(""))
    count = F.greatest(F.coalesce(name(tokens).cast("long"), F.lit(0)), F.lit(0)) if tokens else F.ceil(F.octet_length(body) / CHARS_PER_TOKEN)
    source = rows.select(
        name(conv).alias("conv"), name(turn).cast("long").alias("turn"), F.coalesce(name(role).cast("string"), F.lit("")).alias("role"), body.alias("text"), (count + TURN_TOKENS).alias("cost")
    )
    dealt = _dealt(source, block_turns, history_turns)
    part = Window.partitionBy("conv", "block")
    order = part.orderBy(F.when(F.col("kind") < 0, 0).otherwise(1), F.col("turn").asc_nulls_first(), "role", "text")
    before = F.sum(F.when(F.col("kind") >= 0, F.col("cost")).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("cost")
    out = dealt.withColumns({"pos": F.row_number().over(order), "begin": F.when(F.col("kind") >= 0, before)})

    # The system turn of the block, and the size of a cell beside it.
    candidate = F.when((F.col("kind") != 0) & (F.col("role") == "system"), F.struct("pos", "cost", "turn", F.xxhash64("text").alias("hash")))
    out = out.withColumns({"sys": F.min(candidate).over(part), "origin": F.min(F.when(F.col("kind") == 1, F.col("begin"))).over(part)})
    room = F.greatest(F.lit(budget) - F.coalesce(F.col("sys.cost"), F.lit(0)), F.lit(budget // 2))
    cell = F.floor((room - history_tokens) / 2)
    is_sys = F.coalesce(F.col("pos") == F.col("sys.pos"), F.lit(False))
    window = F.when(F.col("kind") == 1, 2 * F.floor((F.col("begin") - F.col("origin")) / cell) + (F.col("cost") > cell).cast("long"))
    out = out.withColumns({"room": room, "is_sys": is_sys, "window": window})

    # Where windows begin, what they hold of their own, and how much history is left for them.
    own = Window.partitionBy("conv", "block", "window")
    out = out.withColumns({"held": F.sum("cost").over(own), "opens": F.col("kind") == 1, "first_pos": F.min("pos").over(own)})
    out = out.withColumn("opens", F.col("opens") & (F.col("pos") == F.col("first_pos")))
    allowed = F.greatest(F.lit(0).cast("long"), F.least(F.lit(history_tokens).cast("long"), F.col("room") - F.col("held")))
    opening = F.when(F.col("opens"), F.struct("window", "begin", "pos", allowed.alias("allowed")))
    near = part.orderBy("begin").rangeBetween(1, max(1, history_tokens))
    # A system turn that comes before the block is not also repeated as history.
    sent = (F.col("kind") == 0) & (F.col("turn") == F.col("sys.turn")) & (F.xxhash64("text") == F.col("sys.hash")) & (F.col("role") == "system")
    can = (F.col("kind") >= 0) & ~F.col("is_sys") & ~F.coalesce(sent, F.lit(False))
    reached = F.filter(
        F.when(can, F.collect_list(opening).over(near)).otherwise(F.array()),
        lambda o: (o["begin"] - F.col("begin") <= o["allowed"]) & (o["pos"] - F.col("pos") <= history_turns),
    )
    out = out.withColumn("reached", F.transform(reached, lambda o: F.struct(o["window"].alias("window"), F.lit(0).alias("kind"))))
    home = F.when(F.col("kind") == 1, F.array(F.struct("window", F.lit(1).alias("kind")))).when(F.col("is_sys"), F.array(F.struct(F.lit(-1).cast("long").alias("window"), F.lit(-1).alias("kind"))))
    out = out.withColumn("into", F.explode(F.concat(F.coalesce(home, F.array()), F.col("reached"))))
    turns = F.sort_array(F.collect_list(F.struct("into.kind", "pos", "role", "text", "cost")))
    rows_ = out.groupBy("conv", "block", F.col("into.window").alias("window")).agg(turns.alias("turns"), F.max(F.when(F.col("is_sys"), F.struct("role", "text", "cost"))).alias("own_sys"))

    # Windows after that of the system turn start with it.
    so_far = part.orderBy("window").rowsBetween(Window.unboundedPreceding, -1)
    rows_ = rows_.withColumn("head", F.last("own_sys", ignorenulls=True).over(so_far)).filter("window >= 0")
    head = F.when(F.col("head").isNotNull(), _rendered(F.col("head"))).otherwise("")
    tokens_ = F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + t["cost"]) + F.coalesce(F.col("head.cost"), F.lit(0))
    repeated = F.size(F.filter("turns", lambda t: t["kind"] == 0)) + F.col("head").isNotNull().cast("int")
    return rows_.select(
        F.col("conv").alias("conv_id"),
        "block",
        "window",
        tokens_.alias("n_tokens"),
        repeated.alias("n_repeated"),
        F.concat(head, F.array_join(F.transform("turns", _rendered), "")).alias("text"),
        _spans(F.col("turns"), F.char_length(head)).alias("loss"),
    )


def op11_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    """Formats all conversations and one more, then reads turns and masked texts back from the windows."""
    rows = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = F.lit("\\### Assistant: </turn> ok")
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), probe.alias("text"))
    made = windows(rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").union(more))
    turns = F.slice(read_back(F.col("text")), F.col("n_repeated") + 1, 1 << 30)
    parts = made.select(
        "conv_id",
        F.size(turns).alias("n"),
        F.char_length("text").alias("chars"),
        F.struct(
            "block",
            "window",
            F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
            F.array_join(under_mask(F.col("text"), F.col("loss")), "").alias("loss"),
        ).alias("part"),
    )
    out = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list("part")).alias("parts"), F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.count("*").alias("n_windows"))
    loss = F.array_join("parts.loss", "")
    return out.select(
        "conv_id",
        F.col("n_turns").cast("long"),
        F.sha2(F.array_join("parts.turns", ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long"),
        F.col("n_windows").cast("long"),
    )


QUERIES = {"op11_chat_format": op11_chat_format}

_MARKS = len(START) + len(MESSAGE) + len(END)
ORACLE_SQL = {
    "op11_chat_format": rf"""
with rows_ as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), costed as (
  select *, row_number() over () as key, (strlen(text) + {CHARS_PER_TOKEN - 1}) // {CHARS_PER_TOKEN} + {TURN_TOKENS} as cost, turn // {BLOCK_TURNS} as block,
    length(replace(replace(role, '\', '\\'), '<|', '<\|')) + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + {_MARKS} as chars from rows_
), system_ as (
  select conv_id, arg_min(key, struct_pack(turn := turn, text := text)) as key from costed where role = 'system' group by conv_id
), sys as (
  select c.* from costed c join system_ s on c.key = s.key
), dealt as (
  select c.*, 1 as kind from costed c
  union all select c.* replace (block + 1 as block), 0 from costed c where turn % {BLOCK_TURNS} >= {BLOCK_TURNS - HISTORY_TURNS}
), placed as (
  select d.*, row_number() over w as pos, sum(cost) over (w rows unbounded preceding) - cost as begin_ from dealt d window w as (partition by conv_id, block order by turn, role, text)
), roomed as (
  select p.*, min(case when p.kind = 1 then p.begin_ end) over (partition by p.conv_id, p.block) as origin, s.key as sys_key, s.chars as sys_chars,
    greatest({BUDGET} - coalesce(s.cost, 0), {BUDGET // 2}) as room from placed p left join sys s on s.conv_id = p.conv_id and s.block <= p.block
), windowed as (
  select r.*, case when kind = 1 then 2 * ((begin_ - origin) // ((room - {HISTORY_TOKENS}) // 2)) + case when cost > (room - {HISTORY_TOKENS}) // 2 then 1 else 0 end end as win from roomed r
), made as (
  select conv_id, block, win, min(pos) as pos, min(begin_) as begin_, min(room) as room, sum(cost) as held, sum(chars) as chars, any_value(sys_chars) as sys_chars, any_value(sys_key) as sys_key
  from windowed where kind = 1 group by conv_id, block, win
), sys_at as (
  select key, conv_id, block, win from windowed where kind = 1 and key = sys_key
), headed as (
  select m.*, case when s.key is not null and (s.block < m.block or s.win < m.win) then m.sys_chars else 0 end as head from made m left join sys_at s on s.key = m.sys_key
), history as (
  select h.conv_id, h.block, h.win, sum(r.chars) as chars from headed h join windowed r on r.conv_id = h.conv_id and r.block = h.block and r.pos < h.pos
  where r.key is distinct from r.sys_key and h.begin_ - r.begin_ <= least({HISTORY_TOKENS}, h.room - h.held) and h.pos - r.pos <= {HISTORY_TURNS} group by all
), sized as (
  select h.conv_id, sum(h.chars + h.head + coalesce(y.chars, 0)) as formatted_chars, count(*) as n_windows
  from headed h left join history y on y.conv_id = h.conv_id and y.block = h.block and y.win = h.win group by h.conv_id
), digests as (
  select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '') as loss from costed group by conv_id
)
select d.conv_id, n_turns, turns_sha256, cast(length(loss) as bigint) as loss_chars, sha256(loss) as loss_sha256, cast(formatted_chars as bigint) as formatted_chars, n_windows
from digests d join sized s on s.conv_id = d.conv_id
"""
}

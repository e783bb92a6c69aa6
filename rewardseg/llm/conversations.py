"""Prefix trie of conversations through ROLLUP over positional turn columns.

A turn's id is the MD5 of its role and text with the text's length behind,
so equal turns have equal ids and no text is shuffled.  Each conversation
becomes one row per block of ``WIDTH`` turns: the block's number, the node
it continues, and the ids of its turns in positional columns.

Counting.  One ``GROUP BY block, node, ROLLUP(t0 .. t7)`` counts every
prefix of every conversation at once; ``grouping_id`` says how many of the
columns a row still has, so which depth it is.  A block's node is the
prefix before it, named by two 64-bit lanes that XOR a hash of every
(position, turn id); a prefix of any length has its name without walking
there, so all blocks are counted together.

Subtrees.  Leaves and saved tokens of a subtree are sums over its nodes.  A
second ROLLUP adds the nodes of a block.  What lies in later blocks is
added first at the node where it goes on: block totals climb to all their
ancestors by pointer jumping, in about log2(blocks) rounds.

Scale.  Turns are numbered after a range partitioning on (conversation,
turn), so one conversation may span many tasks; just the conversation cut
by a task's edge needs an offset, at most one a task (broadcast).  Both
ROLLUPs combine map-side, so a prefix that a third of the conversations
share costs a row a task.  The list of a node's ends is hashed in order
from chunks of ids; a SHA-256 is sequential, so the chunks of one node
stream through one task, which keeps none of them.

Defined cases: rows with a null conv_id belong to no conversation; a null
role or text is an empty one; turns that share a number come in the order
of their ids (repeated rows are turns); an empty table gives no nodes;
other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rewardseg.llm.common import stage, table, unstage

WIDTH = 8                # turns in a block
FAMILY = 100             # the query's conversations of one family share turns of its first
HEAD = 6                 # fewer than this many turns come from there
CHUNK_IDS = 4096         # conversation ids joined into one text
TURNS = [f"t{i}" for i in range(WIDTH)]


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, turn_id) of every row of a conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    content = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turn_id = F.unhex(F.concat(F.md5(content), F.lpad(F.hex(F.length(text)), 8, "0")))
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                turn_id.alias("turn_id")).where("conv_id is not null")


def code_points(turn_id: Column) -> Column:
    """The length of the text of a turn id."""
    return F.conv(F.hex(F.substring(turn_id, 17, 4)), 16, 10).cast("long")


def _run_starts(keys: np.ndarray, last) -> np.ndarray:
    """True where a key differs from the one before (``last`` before the first)."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    if len(keys) and last is not None:
        new[0] = keys[0] != last
    return new


def numbered(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, turn_id) per turn, and (conv_id, n) per conversation."""
    def run(batches):
        part, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column(0).to_numpy()
            new = _run_starts(conv, last)
            at = np.arange(len(conv))
            start = np.maximum.accumulate(np.where(new, at, -1))
            local = np.where(start < 0, at + count, at - start)
            last, count = conv[-1], int(local[-1]) + 1
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(len(conv), part, np.int32)), pa.array(local),
                                              batch.column(1)], ["conv_id", "part", "local", "turn_id"])
    ordered = (turns.repartitionByRange(F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("turn_id"))
               .sortWithinPartitions(F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("turn_id")))
    local = stage(ordered.select("conv_id", "turn_id").mapInArrow(run, "conv_id long, part int, local long, turn_id binary"), "turns")
    runs = local.groupBy("conv_id", "part").agg((F.max("local") + 1).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # a task's first conversation alone may begin in an earlier task: at most a row per task
    cut = runs.withColumn("before", before).where("before > 0").select(F.col("conv_id").alias("cut_conv"), F.col("part").alias("cut_part"), "before")
    placed = local.join(F.broadcast(cut), (F.col("part") == F.col("cut_part")) & (F.col("conv_id") == F.col("cut_conv")), "left").select(
        "conv_id", (F.col("local") + F.coalesce("before", F.lit(0))).alias("pos"), "turn_id")
    return placed, runs.groupBy("conv_id").agg(F.sum("n").alias("n"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, turn_id, total) of the query's rebuilt conversations:
    the first ``h`` turns of the family's first conversation, then the own
    turns after the first ``h``; h = crc32(decimal id) % HEAD.  One without
    turns is a row with null turn_id."""
    turns, sizes = numbered(turn_rows(conversations))
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = turns.where((F.col("conv_id") == first) & (F.col("pos") < HEAD - 1)).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "turn_id"))).alias("head")).select(F.col("conv_id").alias("first"), "head")
    h = (F.crc32(F.col("conv_id").cast("string")) % HEAD)
    head = F.coalesce(F.slice(F.col("head.turn_id"), F.lit(1), F.col("h").cast("int")), F.array().cast("array<binary>"))
    convs = stage(sizes.withColumn("h", h).withColumn("first", first).join(heads, "first", "left")
                  .select("conv_id", "n", "h", head.alias("head"))
                  .withColumn("total", F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "conversations")
    own = turns.where(F.col("pos") >= h).join(
        convs.select("conv_id", "h", F.size("head").alias("k"), "total"), "conv_id").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "turn_id", "total")
    shared = convs.select("conv_id", F.posexplode("head").alias("pos", "turn_id"), "total").select(
        "conv_id", F.col("pos").cast("long").alias("pos"), "turn_id", "total")
    none = convs.where("total = 0").select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("turn_id"), "total")
    return own.unionByName(shared).unionByName(none)


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, turn_id, total) of the conversations as they are."""
    turns, sizes = numbered(turn_rows(conversations))
    return turns.join(sizes.withColumnRenamed("n", "total"), "conv_id").select("conv_id", "pos", "turn_id", "total")


# -- blocks -------------------------------------------------------------------

def _lane(lane: int, pos: Column, turn_id: Column) -> Column:
    return F.xxhash64(F.lit(lane), pos.cast("long"), turn_id)


def blocks(sequence: DataFrame) -> DataFrame:
    """One row per (conversation, block): conv_id, total, block, the prefix
    before it (k1, k2), the prefix behind it (e1, e2) and t0 .. t7."""
    z = [F.when(F.col("turn_id").isNull(), F.lit(0).cast("long")).otherwise(_lane(i, F.col("pos"), F.col("turn_id"))).alias(f"z{i}") for i in (1, 2)]
    rows = sequence.select("conv_id", "total", F.expr(f"pos div {WIDTH}").alias("block"), "pos", "turn_id", *z)
    ordered = rows.repartitionByRange("conv_id", "block").sortWithinPartitions("conv_id", "pos")
    names = ["conv_id", "total", "block", "part", "x1", "x2", "y1", "y2", *TURNS]

    def emit(held, part):
        conv, total, block, pos, turn, x1, x2, y1, y2 = held
        starts = np.flatnonzero(_run_starts(conv, None) | _run_starts(block, None))
        ends = np.append(starts[1:], len(conv)) - 1
        slots = []
        for i in range(WIDTH):
            has = starts + i <= ends
            slots.append(turn.take(pa.array(np.where(has, np.minimum(starts + i, len(conv) - 1), 0), mask=~has)))
        fixed = [conv[starts], total[starts], block[starts], np.full(len(starts), part, np.int32), x1[starts], x2[starts], y1[ends], y2[ends]]
        return pa.RecordBatch.from_arrays([*map(pa.array, fixed), *slots], names)

    def run(batches):
        part, last, carry, rest = TaskContext.get().partitionId(), None, (0, 0), None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            conv, total, block, pos = (batch.column(i).to_numpy() for i in range(4))
            new = _run_starts(conv, last)
            start = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            before, after = [], []
            for i in (0, 1):  # XOR of the conversation's turns before and up to each turn, as far as this task has them
                up = np.bitwise_xor.accumulate(batch.column(5 + i).to_numpy())
                base = np.where(start > 0, up[np.maximum(start - 1, 0)], 0) ^ np.where(start < 0, np.int64(carry[i]), 0)
                after.append(up ^ base)
                before.append(after[-1] ^ batch.column(5 + i).to_numpy())
            last, carry = conv[-1], (int(after[0][-1]), int(after[1][-1]))
            held = [conv, total, block, pos, batch.column(4), *before, *after]
            if rest is not None:
                held = [pa.concat_arrays([a, b]) if isinstance(a, pa.Array) else np.concatenate([a, b]) for a, b in zip(rest, held)]
            conv, block = held[0], held[2]
            cut = np.flatnonzero((conv != conv[-1]) | (block != block[-1]))
            cut = int(cut[-1]) + 1 if len(cut) else 0
            rest = [a[cut:] if isinstance(a, np.ndarray) else a.slice(cut) for a in held]
            if cut:
                yield emit([a[:cut] if isinstance(a, np.ndarray) else a.slice(0, cut) for a in held], part)
        if rest is not None:
            yield emit(rest, part)

    schema = "conv_id long, total long, block long, part int, x1 long, x2 long, y1 long, y2 long, " + ", ".join(f"{t} binary" for t in TURNS)
    wide = stage(ordered.mapInArrow(run, schema), "blocks")
    # a conversation that goes on from an earlier task lacks what it had there: at most one a task
    per_task = wide.groupBy("conv_id", "part").agg(*[F.bit_xor(F.col(f"x{i}").bitwiseXOR(F.col(f"y{i}"))).alias(f"w{i}") for i in (1, 2)])
    so_far = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    cut = per_task.select(F.col("conv_id").alias("cut_conv"), F.col("part").alias("cut_part"), F.count(F.lit(1)).over(so_far).alias("tasks"),
                          *[F.bit_xor(f"w{i}").over(so_far).alias(f"w{i}") for i in (1, 2)]).where("tasks > 0")
    add = {i: F.coalesce(F.col(f"w{i}"), F.lit(0).cast("long")) for i in (1, 2)}
    return wide.join(F.broadcast(cut), (F.col("part") == F.col("cut_part")) & (F.col("conv_id") == F.col("cut_conv")), "left").select(
        "conv_id", "total", "block", *[F.col(f"x{i}").bitwiseXOR(add[i]).alias(f"k{i}") for i in (1, 2)],
        *[F.col(f"y{i}").bitwiseXOR(add[i]).alias(f"e{i}") for i in (1, 2)], *TURNS)


def rolled(rows: DataFrame, aggregates: str) -> DataFrame:
    """Aggregates of every prefix of every block's turns: block, k1, k2,
    t0 .. t7, j (turns of the block in the prefix) and the aggregates.  The
    empty prefix of a later block is the node that it continues, counted in
    the block before, and is left out."""
    columns = ", ".join(TURNS)
    made = rows.sparkSession.sql(
        f"SELECT block, k1, k2, {columns}, {WIDTH} - bit_count(grouping_id()) AS j, {aggregates} "
        f"FROM {{rows}} GROUP BY block, k1, k2, ROLLUP({columns})", rows=rows)
    # a shorter conversation's missing turns are nulls, and its prefixes end before them
    return made.where(F.when(F.col("j") == 0, F.col("block") == 0).otherwise(F.element_at(F.array(*TURNS), F.greatest("j", F.lit(1))).isNotNull()))


def _name(lane: int, less: int = 0) -> Column:
    """A lane of the name of a rolled row's prefix, ``less`` turns shorter."""
    name = F.col(f"k{lane}")
    for i, t in enumerate(TURNS):
        name = name.bitwiseXOR(F.when(F.col("j") - less > i, _lane(lane, F.col("block") * WIDTH + i, F.col(t))).otherwise(F.lit(0).cast("long")))
    return name


def prefix_nodes(rows: DataFrame) -> DataFrame:
    """The nodes of the trie with their names (id1, id2), their parents'
    (pid1, pid2), depth, smallest member, members and text length."""
    of = rolled(rows, "min(conv_id) AS conv_id, count(1) AS n_convs")
    last = F.element_at(F.array(*TURNS), F.greatest("j", F.lit(1)))
    return of.select("block", "k1", "k2", *TURNS, "j", "conv_id", "n_convs", (F.col("block") * WIDTH + F.col("j")).alias("depth"),
                     F.when(F.col("j") > 0, code_points(last)).otherwise(F.lit(0)).alias("size"),
                     *[_name(i).alias(f"id{i}") for i in (1, 2)], *[_name(i, less=1).alias(f"pid{i}") for i in (1, 2)])


# -- subtrees -----------------------------------------------------------------

def block_totals(nodes: DataFrame) -> DataFrame | None:
    """(b1, b2, leaves, saved) per node that later blocks continue: sums over
    all nodes below it.  None if no conversation reaches a second block."""
    deepest = nodes.agg(F.max("block")).first()[0]
    if not deepest:
        return None
    own = nodes.where("block > 0").groupBy("k1", "k2").agg(F.sum("leaf").alias("leaves"), F.sum("saving").alias("saved"))
    ends = nodes.where(f"j = {WIDTH}").select(F.col("id1").alias("k1"), F.col("id2").alias("k2"), F.when(F.col("block") > 0, F.col("k1")).alias("p1"),
                                              F.when(F.col("block") > 0, F.col("k2")).alias("p2"))
    roots = stage(own.join(ends, ["k1", "k2"]), "block-roots")
    reach = 1
    while reach < deepest:
        # after a round a root has the sums of all roots less than 2 * reach blocks below, and points 2 * reach blocks up
        below = roots.where("p1 is not null").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
            F.sum("leaves").alias("add_leaves"), F.sum("saved").alias("add_saved"))
        up = roots.select(F.col("k1").alias("u1"), F.col("k2").alias("u2"), F.col("p1").alias("q1"), F.col("p2").alias("q2"))
        summed = roots.join(below, ["k1", "k2"], "left").select(
            "k1", "k2", "p1", "p2", (F.col("leaves") + F.coalesce("add_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("add_saved", F.lit(0))).alias("saved"))
        before, roots = roots, stage(summed.join(up, (F.col("p1") == F.col("u1")) & (F.col("p2") == F.col("u2")), "left").select(
            "k1", "k2", F.col("q1").alias("p1"), F.col("q2").alias("p2"), "leaves", "saved"), "block-roots")
        unstage(before)
        reach *= 2
    return roots.select(F.col("k1").alias("b1"), F.col("k2").alias("b2"), "leaves", "saved")


def ends_hash(rows: DataFrame, chunk_ids: int = CHUNK_IDS) -> DataFrame:
    """(id1, id2, ends_sha256): the SHA-256 of the ids, ascending and joined
    by commas, of the conversations that end at each node."""
    def chunks(batches):
        at, ids = None, []

        def row():
            return [at[0]], [at[1]], [ids[0]], [",".join(map(str, ids))]
        for batch in batches:
            out = ([], [], [], [])
            for a, b, c in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if at != (a, b) or len(ids) == chunk_ids:
                    if ids:
                        for to, x in zip(out, row()):
                            to += x
                    at, ids = (a, b), []
                ids.append(c)
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.string())], ["id1", "id2", "least", "ids"])
        if ids:
            out = row()
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.string())], ["id1", "id2", "least", "ids"])

    def digests(batches):
        at, state = None, None
        for batch in batches:
            out = ([], [], [])
            for a, b, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if at != (a, b):
                    if at is not None:
                        for to, x in zip(out, (*at, state.hexdigest())):
                            to.append(x)
                    at, state = (a, b), hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())],
                                             ["id1", "id2", "ends_sha256"])
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int64()), pa.array([at[1]], pa.int64()), pa.array([state.hexdigest()])],
                                             ["id1", "id2", "ends_sha256"])

    last = F.col("block") == F.expr(f"greatest(total - 1, 0) div {WIDTH}")
    ends = rows.where(last).select(F.col("e1").alias("id1"), F.col("e2").alias("id2"), "conv_id")
    parts = (ends.repartitionByRange("id1", "id2", "conv_id").sortWithinPartitions("id1", "id2", "conv_id")
             .mapInArrow(chunks, "id1 long, id2 long, least long, ids string"))
    return (parts.repartition("id1", "id2").sortWithinPartitions("id1", "id2", "least")
            .mapInArrow(digests, "id1 long, id2 long, ends_sha256 string"))


def prefix_trie(sequence: DataFrame) -> DataFrame:
    """One row per distinct prefix of the sequences ((conv_id, pos, turn_id,
    total), as ``sequences`` makes them): conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and the node's
    name, its parent's name and the id of its last turn."""
    rows = stage(blocks(sequence), "block-rows")
    nodes = stage(prefix_nodes(rows), "nodes")
    key = ["id1", "id2"]
    children = nodes.where("depth > 0").groupBy(F.col("pid1").alias("id1"), F.col("pid2").alias("id2")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = stage(nodes.join(children, key, "left").select(
        *nodes.columns, F.coalesce("n_children", F.lit(0)).alias("n_children"), F.col("n_children").isNull().cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saving")), "counted-nodes")
    shares = counted.select("block", "k1", "k2", *TURNS, "j", "id1", "id2", "leaf", "saving")
    later = block_totals(counted)
    if later is not None:  # a full block's node also stands for all that later blocks have below it
        full = shares.where(f"j = {WIDTH}").join(later, (F.col("id1") == F.col("b1")) & (F.col("id2") == F.col("b2")), "left")
        full = full.withColumn("leaf", F.col("leaf") + F.coalesce("leaves", F.lit(0))).withColumn("saving", F.col("saving") + F.coalesce("saved", F.lit(0)))
        shares = shares.where(f"j < {WIDTH}").unionByName(full.select(*shares.columns))
    below = rolled(shares.drop("j"), "sum(leaf) AS n_leaves, sum(saving) AS saved_tokens").select(
        *[_name(i).alias(f"id{i}") for i in (1, 2)], "n_leaves", "saved_tokens")
    parents = nodes.select(F.col("id1").alias("r1"), F.col("id2").alias("r2"), F.col("conv_id").alias("parent_conv_id"))
    name = lambda a, b: F.lower(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))
    whole = stage(counted.join(below, key).join(ends_hash(rows), key, "left"), "trie")
    return whole.join(parents, (F.col("depth") > 0) & (F.col("pid1") == F.col("r1")) & (F.col("pid2") == F.col("r2")), "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), name("id1", "id2").alias("node"),
        F.when(F.col("depth") > 0, name("pid1", "pid2")).alias("parent_node"),
        F.when(F.col("j") > 0, F.element_at(F.array(*TURNS), F.greatest("j", F.lit(1)))).alias("turn_id"))


def turn_texts(trie: DataFrame, conversations: DataFrame) -> DataFrame:
    """The trie's rows with the role and text of their last turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    content = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turn_id = F.unhex(F.concat(F.md5(content), F.lpad(F.hex(F.length(text)), 8, "0")))
    texts = conversations.select(turn_id.alias("turn_id"), role.alias("role"), text.alias("text")).dropDuplicates(["turn_id"])
    return trie.join(texts, "turn_id", "left")


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(table(spark, sf_dir, "conversations"))).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op11_sql() -> str:
    """DuckDB SQL of the query: prefixes as lists of (role, text), subtree
    sums over every node's ancestors.  CRC-32 is spelled out bit by bit."""
    return f"""
WITH t AS (
    SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                              md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, xor(list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ord(ch)::BIGINT)),
               lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
                   lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)), 4294967295) % {HEAD} AS h
    FROM (SELECT DISTINCT conv_id FROM t)
), turns AS (
    SELECT c.conv_id, 0 AS part, t.pos, t.r, t.x FROM convs c JOIN t ON t.conv_id = c.conv_id - c.conv_id % {FAMILY} AND t.pos < c.h
    UNION ALL
    SELECT c.conv_id, 1, t.pos, t.r, t.x FROM convs c JOIN t ON t.conv_id = c.conv_id AND t.pos >= c.h
), seqs AS (
    SELECT c.conv_id, coalesce(list({{'r': r, 'x': x}} ORDER BY part, pos) FILTER (WHERE r IS NOT NULL), []) AS s
    FROM convs c LEFT JOIN turns USING (conv_id) GROUP BY c.conv_id
), nodes AS (
    SELECT s[1:d] AS p, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(s) = d), '') AS ends
    FROM (SELECT conv_id, s, unnest(range(len(s) + 1)) AS d FROM seqs) GROUP BY 1, 2
), kids AS (
    SELECT p[1:depth - 1] AS q, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
), own AS (
    SELECT nodes.*, coalesce(n, 0) AS n_children, CASE WHEN depth > 0 THEN (n_convs - 1) * length(p[depth].x) ELSE 0 END AS saving
    FROM nodes LEFT JOIN kids ON q = p
), below AS (
    SELECT p[1:d] AS q, count(*) FILTER (WHERE n_children = 0) AS leaves, sum(saving) AS saved
    FROM (SELECT p, n_children, saving, unnest(range(depth + 1)) AS d FROM own) GROUP BY 1
)
SELECT own.conv_id, own.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, own.n_convs, own.n_children::BIGINT AS n_children,
       leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(own.ends) AS ends_sha256
FROM own JOIN below ON below.q = own.p LEFT JOIN own up ON own.depth > 0 AND up.p = own.p[1:own.depth - 1]"""

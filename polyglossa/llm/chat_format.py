"""Chat formatting from reply trees.

Iterative self-joins over (node, ancestor) double the distance they span each time, so a tree of any depth needs a
logarithmic number of joins. They give every leaf its path score; the best leaves of each tree are taken, and the same
joins, from the longest span to the shortest, enumerate the nodes of their root-to-leaf paths. Each path is one
conversation.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged, table, written

#: Marks of a turn that is read, and of one that is learned.
READ, LEARNED = ("[INST]", "[/INST]"), ("<s>", "</s>")
_CONTROL = r"(/?INST\]|/?s>)"
_ESCAPE, _UNESCAPE = re.compile(r"([\[<])(\\*)" + _CONTROL), re.compile(r"([\[<])\\(\\*)" + _CONTROL)
_MASK = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_TURN = re.compile(r"\[INST\](.*?)\[/INST\]|<s>(.*?)</s>", re.DOTALL)


def escape(text: str) -> str:
    """A backslash more after the first character of every control string, those with backslashes already included."""
    return _ESCAPE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def _role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unrole(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def format_turns(turns: list[tuple[str, str]], learned: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """(text, loss mask): the mask has the [start, end) places of the learned texts."""
    out, at, mask = [], 0, []
    for role, text in turns:
        begin, end = LEARNED if role == learned else READ
        head, body = f"{begin}{_role(role)}\n", escape(text)
        if role == learned:
            mask.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, end]
        at += len(head) + len(body) + len(end)
    return "".join(out), mask


def read_turns(formatted: str) -> list[tuple[str, str]]:
    out = []
    for m in _TURN.finditer(formatted):
        role, _, text = (m[1] if m[1] is not None else m[2]).partition("\n")
        out.append((_unrole(role), unescape(text)))
    return out


def chat_format(nodes: DataFrame, branches: int | None = 1, learned: str = "assistant") -> DataFrame:
    """One row per chosen path of each tree: tree, leaf, path_score, n_turns, formatted and mask (start, end).

    nodes: tree, node (unique in its tree), parent (null or unknown for a root), role, text, score; other columns are
    not read. A path's score is the mean score of its nodes; each tree's `branches` best leaves are taken (None: all),
    ties by the longer path, then by the smaller leaf. Null role or text is empty, a null score 0. Rows with a null tree
    are one tree of their own; rows without node are left out, and equal rows must not share a node id. A tree whose
    parents form a circle raises an error.
    """
    kinds = dict(nodes.dtypes)
    # As a structure the tree is equal to itself where it is null.
    nodes = nodes.where("node IS NOT NULL").withColumn("tree", F.struct("tree"))
    known = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    light = nodes.select("tree", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("sum")).join(known, ["tree", "parent"], "left")
    first = light.select("tree", "node", F.when(F.col("known"), F.col("parent")).alias("up"), "sum", F.lit(1).cast("long").alias("n"))
    rounds = [written(first, "jumps")]
    # However many rounds there were, one scan reads them: plans stay small, and so does the driver's memory.
    read = lambda *paths: nodes.sparkSession.read.schema(first.schema).parquet(*paths)
    most = 0
    # Only nodes that have not met their root yet are joined again; those that have are set aside.
    while not (still := read(rounds[-1]).where("up IS NOT NULL")).isEmpty():
        # After k jumps a node has met its 2^k-th ancestor: more than there are nodes are a circle.
        most = most or (read(rounds[0]).count() if len(rounds) > 4 else 0)
        if most and 2 ** (len(rounds) - 1) > 2 * most:
            raise ValueError("the parents of a tree form a circle")
        above = still.unionByName(read(*rounds).where("up IS NULL")).select("tree", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("sum").alias("sum2"), F.col("n").alias("n2"))
        farther = still.join(above, ["tree", "up"]).select("tree", "node", F.col("up2").alias("up"), (F.col("sum") + F.col("sum2")).alias("sum"), (F.col("n") + F.col("n2")).alias("n"))
        rounds.append(written(farther, "jumps"))
    jumps = [read(path).where("up IS NOT NULL").select("tree", "node", "up") for path in rounds[:-1]]
    inner = read(rounds[0]).where("up IS NOT NULL").select("tree", F.col("up").alias("node")).distinct()
    leaves = read(*rounds).where("up IS NULL").join(inner, ["tree", "node"], "left_anti").select("tree", F.col("node").alias("leaf"), (F.col("sum") / F.col("n")).alias("path_score"), "n")
    if branches is not None:
        best = Window.partitionBy("tree").orderBy(F.desc("path_score"), F.desc("n"), "leaf")
        leaves = leaves.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= branches).drop("_rank")
    path = staged(leaves.select("tree", "leaf", "path_score", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("back")), "paths")
    for k in range(len(jumps) - 1, -1, -1):
        # Each row goes on as itself and, where it reaches so far, as its ancestor; one join a level, no self-union, and a
        # table a level, as one plan of all levels would have the driver keep their joins at once.
        both = F.array(F.struct("node", "back"), F.struct(F.col("up").alias("node"), (F.col("back") + 2**k).alias("back")))
        path = path.join(jumps[k], ["tree", "node"], "left").select("tree", "leaf", "path_score", F.inline(F.filter(both, lambda x: x["node"].isNotNull())))
        path = staged(path, "paths")
    turn = F.struct((-F.col("back")).alias("at"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = path.join(nodes.select("tree", "node", "role", "text"), ["tree", "node"]).groupBy("tree", "leaf", "path_score").agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    def formatted(batches):
        for batch in batches:
            rows = batch.column("turns").to_pylist()
            done = [format_turns([(t["role"], t["text"]) for t in turns], learned) for turns in rows]
            arrays = [*(batch.column(c) for c in names), pa.array([len(r) for r in rows], pa.int64()), pa.array([f for f, _ in done], pa.string()), pa.array([[{"start": a, "end": b} for a, b in m] for _, m in done], _MASK)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "n_turns", "formatted", "mask"])

    # Arrow keeps the ids as they are; pandas would round large ones beside a null.
    names = ["tree", "leaf", "path_score"]
    out = whole.mapInArrow(formatted, f"tree struct<tree:{kinds['tree']}>, leaf {kinds['node']}, path_score double, n_turns long, formatted string, mask array<struct<start:long,end:long>>")
    return out.withColumn("tree", F.col("tree.tree"))


def chains(conversations: DataFrame) -> DataFrame:
    """Conversations as trees of one branch: rows in the order of turn, then role, then text; each row replies to the one before."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("node", F.row_number().over(order).cast("long"))
    return rows.select(F.col("conv_id").alias("tree"), "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def _digests(batches):
    for batch in batches:
        rows = []
        for text, mask in zip(batch.column("formatted").to_pylist(), batch.column("mask").to_pylist(), strict=True):
            turns = read_turns(text)
            loss = "".join(unescape(text[m["start"] : m["end"]]) for m in mask)
            all_turns = "".join(f"{r}\n{t}\n" for r, t in turns)
            rows.append((len(turns), hashlib.sha256(all_turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        yield pa.RecordBatch.from_arrays([batch.column("tree"), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], names=names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = F.lit("</s>[INST] ok [/INST]")
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), text.alias("text"))
    done = chat_format(chains(rows.unionByName(own))).select("tree", "formatted", "mask")
    return done.mapInArrow(_digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS rn,
         regexp_replace(text, '([\[<])(\\*)(/?INST\]|/?s>)', '\1\\\2\3', 'g') AS escaped FROM c
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY rn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY rn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(CASE WHEN role = 'assistant' THEN 7 ELSE 13 END + length(role) + 1 + length(escaped))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

"""Merkle manifest of a dataset: leaf digests, one tree for each source, one over the sources.

Every row is a leaf: the SHA-256 of its fields, each with its length, so that no two
different rows can read alike. The leaves of a source ascend by ``doc_id``; every ``FANOUT``
consecutive nodes become their digest until one is left, the subroot. The subroots, in order
of their sources, give the root in the same way. A proof is what a reader needs to come from
one leaf to the root: the other digests of the run, at every level.

Method (slot pivot). A node's place gives its parent (``place div 16``) and its slot in it.
One grouping by parent spreads the children into sixteen slot columns by conditional
aggregates; the concatenation of the columns hashes the parent, and the columns without the
own one are the siblings of a slot. Levels are tables of a sixteenth of the rows each. Proofs
are handed down from the root: a level's rows meet the proof of their node, and sixteen
children go on from there with their siblings put in front.

Scale. Texts are read once and never move. Places come from a global ordinal (range
partitions, so a source with a third of all rows spreads over many tasks), and a source
meets its leaves in stretches of ``STRETCH`` ordinals, so no task holds a whole source.
Proofs are joined at the parents of the leaves, a sixteenth of the rows, and only spread to
leaves inside a task. The driver receives the height of the trees and the root.

Edge cases. A null field is ``-``; an empty text is ``0:``. A null ``doc_id`` comes first in
its source, a null source before all others. Rows that repeat a ``doc_id`` in a source go by
their leaf digest; rows equal in all five fields are leaves of their own with equal digests.
A lone leaf is the subroot itself, and a lone subroot the root. Very long texts are hashed
whole. Other columns are ignored; an empty table gives an empty result and no root.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import discard, staged
from stellate.operators.ordinal import global_ordinal

FANOUT = 16
#: Consecutive ordinals of a source that meet its row in one key.
STRETCH = 4096
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A field with its length in bytes, or ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """The digest of a row, with some of its fields changed."""
    return digest(*[field(changed.get(f, F.col(f))) for f in FIELDS])


def _slots() -> list[str]:
    return [f"c{s}" for s in range(FANOUT)]


def pivoted(nodes: DataFrame, *payload: str) -> DataFrame:
    """The parents of ``nodes (tree, pos, n, digest, …)``: their children in slot columns,
    and their own digest. ``n`` is the number of nodes that the tree has on a level."""
    slot = F.col("pos") % FANOUT
    child = F.struct("digest", *payload)
    up = lambda c: F.floor(c / F.lit(FANOUT)).cast("long")
    runs = nodes.groupBy("tree", up(F.col("pos")).alias("pos"), up(F.col("n") + FANOUT - 1).alias("n")).agg(
        *[F.max(F.when(slot == s, child)).alias(c) for s, c in enumerate(_slots())]
    )
    return runs.withColumn("digest", digest(F.concat_ws("", *[f"{c}.digest" for c in _slots()])))


def children(runs: DataFrame, *payload: str) -> DataFrame:
    """``runs`` with a ``proof`` taken apart again: each child with its own proof, the columns
    left and right of its slot in front."""
    joined = lambda cs: f"concat_ws('', {', '.join(f'{c}.digest' for c in cs) or chr(39) * 2})"
    rows = []
    for s, c in enumerate(_slots()):
        step = f"struct({joined(_slots()[:s])} AS left, {joined(_slots()[s + 1 :])} AS right) AS step"
        kept = ", ".join(f"{c}.{p} AS {p}" for p in ("digest", *payload))
        rows.append(f"IF({c} IS NOT NULL, struct(pos * {FANOUT} + {s} AS pos, {step}, {kept}), NULL)")
    out = runs.select("tree", "subroot", "proof", F.expr(f"explode(array_compact(array({', '.join(rows)})))").alias("child"))
    return out.select("tree", "child.pos", "subroot", F.concat(F.array("child.step"), "proof").alias("proof"), *[f"child.{p}" for p in ("digest", *payload)])


@dataclass
class Forest:
    """Trees over ``(tree, pos, n, digest, …)``: the leaves, the levels above them, the tops."""

    leaves: DataFrame
    levels: list[DataFrame]
    tops: DataFrame
    payload: tuple[str, ...]

    def handed_down(self, proofs: DataFrame) -> DataFrame:
        """``proofs (tree, subroot, proof)`` of the tops carried down to every leaf."""
        arrived = lambda level: level.where("n = 1").join(proofs, "tree")
        above = None
        for i in range(len(self.levels) - 1, -1, -1):
            level = self.levels[i]
            here = arrived(level).select("tree", "pos", "subroot", "proof")
            if above is not None:
                here = here.unionByName(above.select("tree", "pos", "subroot", "proof"))
            above = children(level.join(here, ["tree", "pos"]), *(self.payload if i == 0 else ()))
        lone = arrived(self.leaves).select("tree", "pos", "subroot", "proof", "digest", *self.payload)
        return lone if above is None else lone.unionByName(above)

    def discard(self) -> None:
        discard(*self.levels)


def grown(leaves: DataFrame, most: int, name: str, *payload: str) -> Forest:
    """Levels over ``leaves`` until every tree has one node; ``most`` is the largest ``n``."""
    levels, nodes = [], leaves
    tops = leaves.where("n = 1").select("tree", "digest")
    while most > 1:
        levels.append(staged(pivoted(nodes.where("n > 1"), *(payload if not levels else ())), f"merkle-{name}-{len(levels) + 1}"))
        nodes, most = levels[-1].select("tree", "pos", "n", "digest"), -(-most // FANOUT)
        tops = tops.unionByName(nodes.where("n = 1").select("tree", "digest"))
    return Forest(leaves, levels, tops, payload)


def placed(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows (doc_id, source, digest, …)`` with their tree (the first ordinal of the source),
    place in it and number of leaves; and the largest such number."""
    order = {"__s": F.col("source").isNotNull(), "__i": F.col("doc_id").isNotNull()}
    numbered = staged(global_ordinal(rows.withColumns(order), ["__s", "source", "__i", "doc_id", "digest"]).drop(*order), "merkle-ordinals")
    sources = staged(numbered.groupBy("source").agg(F.min("rn").alias("tree"), F.count(F.lit(1)).alias("n")), "merkle-sources")
    most = sources.agg(F.max("n")).first()[0] or 0
    stretch = lambda c: F.floor(c / F.lit(STRETCH)).cast("long")
    spread = sources.select("source", "tree", "n", F.explode(F.sequence(stretch(F.col("tree")), stretch(F.col("tree") + F.col("n") - 1))).alias("__at")).withColumnRenamed("source", "__source")
    met = numbered.withColumn("__at", stretch(F.col("rn"))).join(spread, ["__at"])
    met = met.where(F.col("source").eqNullSafe(F.col("__source")) & F.col("rn").between(F.col("tree"), F.col("tree") + F.col("n") - 1))
    out = staged(met.withColumn("pos", F.col("rn") - F.col("tree")).drop("__at", "__source", "rn", "source"), "merkle-leaves")
    discard(numbered, sources)
    return out, most


def proofs(docs: DataFrame) -> tuple[DataFrame, str | None]:
    """Each row's ``doc_id``, ``leaf``, ``tampered`` (the leaf it would have with its text's
    A-Z lower-cased, for ids whose CRC-32 five divides), ``subroot`` and ``proof`` (steps of
    left and right siblings up to the root); and the root."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select(*FIELDS).select(
        "doc_id", "source", leaf().alias("digest"), F.when(crc % 5 == 0, leaf(text=F.translate(F.col("text"), UPPER, LOWER))).alias("tampered")
    )
    hashed = staged(rows, "merkle-hashed")
    leaves, most = placed(hashed)
    trees = grown(leaves, most, "source", "doc_id", "tampered")

    tops = staged(trees.tops, "merkle-subroots")
    n = tops.count()
    ranked = global_ordinal(tops, ["tree"]).select(F.lit(0).cast("long").alias("tree"), (F.col("rn") - 1).alias("pos"), F.lit(n).cast("long").alias("n"), "digest", F.col("tree").alias("of"))
    subroots = staged(ranked, "merkle-ranked")
    over = grown(subroots, n, "root", "of")
    root = over.tops.first()
    step = "array<struct<left:string,right:string>>"
    top = over.tops.select("tree", F.lit("").alias("subroot"), F.array().cast(step).alias("proof"))
    down = over.handed_down(top).select(F.col("of").alias("tree"), F.col("digest").alias("subroot"), "proof")
    out = trees.handed_down(down).select("doc_id", F.col("digest").alias("leaf"), "tampered", "subroot", "proof")
    out._held = (hashed, leaves, tops, subroots, *trees.levels, *over.levels)
    return out, root["digest"] if root else None


def folded(node: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, node, lambda at, step: digest(step["left"], at, step["right"]))


def manifest(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: its leaf, subroot and root, the digest of its proof, the
    root that its (tampered) leaf folds to, and whether that is the root."""
    rows, root = proofs(docs)
    siblings = F.array_join(F.transform("proof", lambda step: F.concat(step["left"], step["right"])), "")
    out = rows.select(
        "doc_id",
        "leaf",
        "subroot",
        F.lit(root).cast("string").alias("root"),
        digest(siblings).alias("proof_sha256"),
        folded(F.coalesce("tampered", "leaf"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
    done = staged(out, "merkle-manifest")
    discard(*rows._held)
    return done

"""Audit of how filters interact: what each filter removes in every order.

A document's *failure mask* has one bit per filter that it fails.  Spark counts
the documents (all, good, toxic) of every (part, mask) with partial aggregates;
what is left per part are at most 2**k rows, however many documents there are.

Per part the counts become a decision diagram: a level per filter, in the order
in which the filters are applied, and at each node a *pass* and a *fail* edge;
equal nodes are shared, and every node knows the documents that reach it
(its counts).  The path of pass edges from the root is what the filters keep,
the fail edges that leave it are what each of them removes.  One order becomes
the next by swapping two adjacent levels, which rebuilds those two levels only;
the orders are visited so that each differs from the last by one such swap.

Defined results: a null text is empty; a null part is the empty string; a row
without an id neither has nor is a copy with a smaller id; rows that repeat an
id count one by one and, where they share the smallest id of their text, all
pass the copy filter; an id that is labelled more than once is good (toxic) if
any of its labels says so; rows without labels are neither.  Other columns
are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import read

Counts = tuple[int, ...]


class Diagram:
    """A shared decision diagram over failure masks whose leaves are counts.

    ``nodes[n]`` is (pass child, fail child) or, for a leaf, its counts;
    ``total[n]`` are the counts of all documents below node n.
    """

    def __init__(self, order: str, masks: dict[frozenset, Counts], width: int):
        self.order = list(order)
        self.nodes: list[tuple] = []
        self.total: list[Counts] = []
        self._known: dict[tuple, int] = {}
        self._empty = (0,) * width

        def build(level: int, failed: frozenset) -> int:
            if level == len(order):
                return self._leaf(masks.get(failed, self._empty))
            return self._node(build(level + 1, failed), build(level + 1, failed | {order[level]}))

        self.root = build(0, frozenset())

    def _leaf(self, counts: Counts) -> int:
        return self._add(("leaf", *counts), counts)

    def _node(self, passed: int, failed: int) -> int:
        return self._add((passed, failed),
                         tuple(map(sum, zip(self.total[passed], self.total[failed]))))

    def _add(self, node: tuple, total: Counts) -> int:
        if node not in self._known:
            self._known[node] = len(self.nodes)
            self.nodes.append(node)
            self.total.append(total)
        return self._known[node]

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and ``level + 1``; nodes below the
        two levels are kept, nodes above are linked to the rebuilt ones."""
        done: dict[int, int] = {}

        def rebuilt(node: int, depth: int) -> int:
            if node not in done:
                passed, failed = self.nodes[node]
                if depth < level:
                    done[node] = self._node(rebuilt(passed, depth + 1), rebuilt(failed, depth + 1))
                else:
                    (pp, pf), (fp, ff) = self.nodes[passed], self.nodes[failed]
                    done[node] = self._node(self._node(pp, fp), self._node(pf, ff))
            return done[node]

        self.root = rebuilt(self.root, 0)
        self.order[level:level + 2] = reversed(self.order[level:level + 2])

    def steps(self) -> Iterator[tuple[str, Counts, Counts]]:
        """Along the all-pass path: (filter, counts kept, counts removed)."""
        node = self.root
        for name in self.order:
            passed, failed = self.nodes[node]
            yield name, self.total[passed], self.total[failed]
            node = passed


def adjacent_swaps(n: int) -> Iterator[int]:
    """Levels to swap so that n! - 1 adjacent swaps visit every order: the
    last item walks through each order of the others, back and forth."""
    if n < 2:
        return
    forth, others = False, adjacent_swaps(n - 1)
    while True:
        yield from range(n - 1) if forth else range(n - 2, -1, -1)
        forth = not forth
        inner = next(others, None)
        if inner is None:
            return
        yield inner + forth


def audit_masks(masks: dict[frozenset, Counts], filters: str) -> Iterator[dict]:
    """One row per order and step from the counts (all, good, toxic) of masks."""
    diagram = Diagram(filters, masks, 3)
    paths = {"".join(diagram.order): list(diagram.steps())}
    for level in adjacent_swaps(len(filters)):
        diagram.swap(level)
        paths["".join(diagram.order)] = list(diagram.steps())
    failing, only, shapley = {}, {}, dict.fromkeys(filters, 0)
    for path in paths.values():
        failing[path[0][0]] = path[0][2][0]              # first: removes all that fail it
        only[path[-1][0]] = path[-1][2][0]               # last: removes what no other does
        for name, _, removed in path:
            shapley[name] += removed[0]
    for order in sorted(paths):
        for step, (name, kept, removed) in enumerate(paths[order], 1):
            yield {"filter_order": order, "step": step, "kept": kept[0], "removed": removed[0],
                   "redundant": failing[name] - removed[0], "unique_fails": only[name],
                   "good_lost": removed[1], "toxic_lost": removed[2], "shapley": shapley[name]}


RESULT = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
          "unique_fails long, good_lost long, toxic_lost long, shapley long")


def audit(counted: DataFrame, filters: str) -> DataFrame:
    """The audit of (part, mask, n, good, toxic), mask bit i being the failure
    of the i-th of ``filters``; a part has at most 2**len(filters) rows."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        masks = {frozenset(f for i, f in enumerate(filters) if mask >> i & 1): (int(n), int(good), int(toxic))
                 for mask, n, good, toxic in zip(rows["mask"], rows["n"], rows["good"], rows["toxic"])}
        out = pd.DataFrame(audit_masks(masks, filters))
        out.insert(0, "part", rows["part"].iloc[0])
        return out

    return counted.groupBy("part").applyInPandas(run, RESULT)


def text_failures(text: Column) -> Column:
    """Bits 0 to 3: too short, repetitive, shouting, odd marks."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    size = F.size(words)
    fails = [size < 200,
             100 * F.size(F.array_distinct(words)) < 50 * size,
             100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 3 * F.length(text),
             text.rlike("[#$%&*|]")]
    return sum((f.cast("int") * (1 << i) for i, f in enumerate(fails[1:], 1)), fails[0].cast("int"))


def _label(labels: DataFrame, doc_id: str) -> DataFrame:
    flags = [F.max((F.col(c) == 1).cast("int")).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))]
    return labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(*flags)


def count_masks(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                part: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic); mask bits 0 to 4 are the failures of A to E.

    Texts are hashed in the scan and go no further.  Equal texts share bits A
    to D, so the copy filter E needs, of each text, only the rows that hold its
    smallest id: every other row with an id fails it.  A text's rows are
    pre-aggregated per task before they are shuffled, whatever their number.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(part), F.lit("")).alias("part"),
                       F.unhex(F.sha2(body.cast("binary"), 256)).alias("key"), text_failures(body).alias("bits"))
    known = (rows.where("id is not null").groupBy("id", "part", "key", "bits").agg(F.count("*").alias("n"))
             .join(_label(labels, doc_id), F.col("id") == F.col("_id"), "left")
             .select("part", "key", "bits", "id", "n",
                     *[(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")]))
    # per text and part: the sums, and the row of the smallest id
    held = known.groupBy("key", "bits", "part").agg(
        *[F.sum(c).alias(c) for c in ("n", "good", "toxic")],
        F.min(F.struct("id", "n", "good", "toxic")).alias("low"))
    low = held.groupBy("key").agg(F.min("low.id").alias("first_id")).withColumnRenamed("key", "_key")
    held = held.join(low, F.col("key") == F.col("_key"))
    first = F.col("low.id") == F.col("first_id")
    split = held.select("part", "bits", F.explode(F.array(*[
        F.struct(F.lit(e << 4).alias("copy"),
                 *[(F.when(first, F.col(f"low.{c}")).otherwise(F.lit(0)) if not e
                    else F.col(c) - F.when(first, F.col(f"low.{c}")).otherwise(F.lit(0))).alias(c)
                   for c in ("n", "good", "toxic")]) for e in (0, 1)])).alias("s"))
    counted = split.select("part", (F.col("bits") + F.col("s.copy")).alias("mask"), "s.n", "s.good", "s.toxic")
    unknown = rows.where("id is null").select(
        "part", F.col("bits").alias("mask"), F.lit(1).cast("long").alias("n"),
        F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("toxic"))
    return counted.unionByName(unknown).groupBy("part", "mask").agg(
        *[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(count_masks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")), "ABCDE")


def oracle() -> str:
    orders = ", ".join(f"('{''.join(p)}')" for p in permutations("ABCDE"))
    return f"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w, min(doc_id) OVER (PARTITION BY text) AS low FROM t),
m AS (SELECT part, (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
        + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text))::INT
        + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(doc_id > low, false)::INT AS mask,
      coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1), false) AS good,
      coalesce(doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1), false) AS toxic FROM w),
c AS (SELECT part, mask, count(*) AS n, sum(good::INT) AS good, sum(toxic::INT) AS toxic FROM m GROUP BY ALL),
o AS (SELECT p.filter_order, s.step, 1 << (ascii(substr(filter_order, s.step::INT, 1)) - 65) AS bit,
        (SELECT coalesce(sum(1 << (ascii(substr(filter_order, b::INT, 1)) - 65)), 0) FROM range(1, 6) r(b) WHERE b < s.step) AS before
      FROM (VALUES {orders}) p(filter_order), range(1, 6) s(step)),
r AS (SELECT c.part, o.filter_order, o.step, o.bit,
        sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN mask & before > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM c, o GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r"""

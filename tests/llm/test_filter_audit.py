"""The filter audit against a plain application of the filters in each order."""
import random
import re
from itertools import permutations

from llm_fixtures import DOCS, docs, empty, prepared, texts  # noqa: F401
from quarry.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, toxic int"


def plain(rows, labels):
    """{(part, order, step): (kept, removed, redundant, unique, good, toxic, shapley)} by removing documents."""
    low = {}
    for r in rows:
        if r.doc_id is not None:
            low[r.text or ""] = min(low.get(r.text or "", r.doc_id), r.doc_id)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts = {}
    for r in rows:
        text = r.text or ""
        words = WORD.findall(text)
        failed = {name for name, bad in {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search("[#$%&*|]", text)),
            "E": r.doc_id is not None and low[text] < r.doc_id}.items() if bad}
        parts.setdefault(r.lang or "", []).append((failed, r.doc_id in good, r.doc_id in toxic))
    out = {}
    for part, all_docs in parts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = all_docs
            for step, name in enumerate(order, 1):
                gone = [d for d in left if name in d[0]]
                left = [d for d in left if name not in d[0]]
                shapley[name] += len(gone)
                failing = sum(name in d[0] for d in all_docs)
                out[part, "".join(order), step] = [
                    len(left), len(gone), failing - len(gone), sum(d[0] == {name} for d in all_docs),
                    sum(d[1] for d in gone), sum(d[2] for d in gone)]
        for key, row in out.items():
            if key[0] == part:
                row.append(shapley[key[1][key[2] - 1]])
    return out


def got(frame):
    rows = frame.collect()
    out = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost,
                                              r.toxic_lost, r.shapley] for r in rows}
    assert len(out) == len(rows)
    return out


def run(docs, labels, **columns):
    return filter_audit.audit(filter_audit.count_masks(docs, labels, **columns), "ABCDE")


def test_every_order_by_hand(spark, docs):
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 40, 2)] + [(4, 0, 1), (None, 1, 1), (7, None, None)]
    rng = random.Random(2)
    more = [(100 + i, " ".join(rng.choices(["Foo", "bar", "b$z", "qux", "Q"] + [f"w{j}" for j in range(400)],
                                            k=rng.choice([3, 150, 250, 700]))), rng.choice(["de", "fr", None, ""]),
             None, None) for i in range(80)]
    more += [(r[0] + 1000, r[1], rng.choice(["de", "fr"]), None, None) for r in more[::3]]   # copies, other parts
    more += [more[0], (None, more[0][1], "de", None, None), (100, more[0][1], "fr", None, None), (100, "x", "de", None, None)]
    table = docs.union(spark.createDataFrame(more, DOCS))
    frame = spark.createDataFrame(labels, LABELS)
    expected = plain(table.collect(), labels)
    assert got(run(table, frame)) == expected
    # columns of the same names as the operator's own are ignored
    clash = table.withColumnsRenamed({"doc_id": "id", "text": "key", "lang": "n"})
    clash = clash.selectExpr("*", "1 AS part", "'m' AS mask", "7 AS good", "id AS _id")
    labels_clash = frame.withColumnRenamed("doc_id", "id").selectExpr("*", "2 AS good", "3 AS _id")
    assert got(run(clash, labels_clash, doc_id="id", text="key", part="n")) == expected


def test_swaps_visit_every_order_and_share_nodes():
    masks = {frozenset(c for i, c in enumerate("ABCDE") if m >> i & 1): (m % 3, 0, 0) for m in range(32)}
    diagram = filter_audit.Diagram("ABCDE", masks, 3)
    seen = {"".join(diagram.order)}
    for level in filter_audit.adjacent_swaps(5):
        diagram.swap(level)
        seen.add("".join(diagram.order))
        fresh = filter_audit.Diagram("".join(diagram.order), masks, 3)
        assert list(diagram.steps()) == list(fresh.steps())
    assert len(seen) == 120
    assert sum(node[0] == "leaf" for node in diagram.nodes) == 3     # equal counts share a leaf


def test_empty_table_and_no_labels(spark, docs, empty):
    none = spark.createDataFrame([], LABELS)
    assert run(empty, none).count() == 0
    assert got(run(docs, none)) == plain(docs.collect(), [])

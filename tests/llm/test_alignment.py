"""Token alignment against the tokenizers' own whole-text encodings and a plain double loop."""
import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from llm_fixtures import DOCS, docs, empty, prepared, texts  # noqa: F401
from quarry.llm import alignment

JSON, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

ODD = ["a  b", " lead", "tail ", "x\n y\n\n  z", "   ", "\n", "<s> </s> <0x41> <unk> <|endoftext|>", "a▁b", "▁",
       "tab\t \tx", "é́ ﬁ ½ \x00 \x1c \x85 q", "🙂🙂 漢字漢字 " * 5, "don't  won't's", "a" * 3000, " 　 b", "x \x1c y"]


@pytest.fixture(scope="module")
def table(spark, docs):
    return docs.union(spark.createDataFrame([(5000 + i, t, None, None, 0) for i, t in enumerate(ODD)], DOCS))


@pytest.fixture(scope="module")
def plain():
    a = tokenizers.Tokenizer.from_file(JSON)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    letters = alignment.byte_of_letter()

    def of(text):
        """ids of both sides, groups, links"""
        if not text:
            return [], [], [], []
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
                   else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            return [], [], [], []

        def ranges(tokens):
            at, out = 0, []
            for t in tokens:
                out.append((at, at + len(t)))
                at += len(t)
            return out

        ra, rb = ranges(bytes_a), ranges(bytes_b)
        cuts = {e for _, e in ra} & {e for _, e in rb}
        groups, low = [], 0
        for cut in sorted(cuts):
            groups.append(([i for i, (s, e) in enumerate(ra) if low <= s and e <= cut] if len(ra) < 400 else None,
                           [j for j, (s, e) in enumerate(rb) if low <= s and e <= cut] if len(rb) < 400 else None))
            low = cut
        links, j = [], 0
        for i, (s, e) in enumerate(ra):
            while rb[j][1] <= s:
                j += 1
            k = j
            while k < len(rb) and rb[k][0] < e:
                links.append((i, k))
                k += 1
        return ids_a, ids_b, groups, links
    return of


def written(ids_a, ids_b, groups):
    return ";".join(",".join(str(ids_a[i]) for i in x) + "|" + ",".join(str(ids_b[j]) for j in y) for x, y in groups)


def test_digests(table, plain):
    got = alignment.digests(table, JSON, MODEL, block_bytes=5000).collect()
    rows = table.collect()
    assert len(got) == len(rows)
    known = {r.text: plain(r.text) for r in rows}
    count = Counter()
    for r in rows:
        a, b, _, links = known[r.text]
        count.update((a[i], b[j]) for i, j in links)
    highest = {}
    for (_, b), n in count.items():
        highest[b] = max(n, highest.get(b, 0))
    expected = Counter()
    for r in rows:
        a, b, groups, links = known[r.text]
        pairs = [(a[i], b[j]) for i, j in links]
        small = groups and groups[0][0] is not None and groups[0][1] is not None
        expected[r.doc_id, len(a), len(b), len(groups), len(links), sum(count[p] == highest[p[1]] for p in pairs),
                 sum(count[p] for p in pairs),
                 hashlib.sha256(written(a, b, groups).encode()).hexdigest() if small else "" if not a else "?"] += 1
    large = {r.doc_id for r in rows if known[r.text][2] and known[r.text][2][0][0] is None
             or known[r.text][2] and known[r.text][2][0][1] is None}
    assert expected == Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum,
                                "?" if r.doc_id in large else r.groups_sha256) for r in got)
    assert sum(r.n_a == 0 for r in got) >= 4         # null, empty, and characters that B writes spaces with


def test_general_interface(table, plain):
    wide = table.withColumnRenamed("doc_id", "id").withColumnRenamed("text", "a_ids").selectExpr("*", "'x' AS doc", "1 AS text")
    texts = {(r.doc_id, r.text) for r in table.collect()}
    got = alignment.align(wide, JSON, MODEL, doc_id="id", text="a_ids", block_bytes=20000)
    assert got.count() == table.count()
    by_id = dict(texts)
    for r in got.collect():
        a, b, groups, links = plain(by_id[r.doc_id])
        assert (r.a_ids, r.b_ids) == (a, b) and sorted(zip(r.a_links, r.b_links)) == links
        assert len(r.a_cuts) == len(r.b_cuts) == len(groups)
        if groups and groups[0][0] is not None and groups[0][1] is not None:
            assert r.a_cuts == [x[-1] + 1 for x, _ in groups] and r.b_cuts == [y[-1] + 1 for _, y in groups]


def test_lanes_and_memory_change_nothing(texts, monkeypatch):
    with open(JSON, "rb") as j, open(MODEL, "rb") as m:
        tok = alignment.loaded(j.read(), m.read())
    texts = [t for t in texts if t] + ODD
    whole = alignment.align_block(texts, alignment.Units(tok))
    monkeypatch.setattr(alignment, "LANE", 16)
    monkeypatch.setattr(alignment, "REMEMBER", 0)
    units = alignment.Units(tok)
    parts = [alignment.align_block([t], units) for t in texts]
    assert [x for p in parts for x in alignment.group_digests(p, tok)] == alignment.group_digests(whole, tok)
    assert sum(len(p.link_a) for p in parts) == len(whole.link_a)


def test_empty_table(empty):
    assert alignment.digests(empty, JSON, MODEL).count() == 0
    assert alignment.align(empty, JSON, MODEL).count() == 0

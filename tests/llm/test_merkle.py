"""The manifest and its proofs against trees built plainly, level by level."""

import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from regtables.llm import merkle

H = lambda *parts: sha256("".join(parts).encode()).hexdigest()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, tree long, leaf string, place int"


def leaf_of(doc_id, source, lang, n_chars, text):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def siblings(nodes, pos):
    """Of a leaf, (left, right) level by level, and the root."""
    way = []
    while len(nodes) > 1:
        low = pos - pos % 3
        way.append(("".join(nodes[low:pos]), "".join(nodes[pos + 1 : low + 3])))
        nodes, pos = [H(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)], pos // 3
    return way, nodes[0]


def wanted(docs):
    """doc_id, leaf, subroot, root, proof, folded root of the text without newlines if the id is even."""
    by_source = {}
    for i, text, lang, source, n in docs:
        shown = text.replace("\n", "") if text is not None and i is not None and i % 2 == 0 else text
        by_source.setdefault(source, []).append((i, leaf_of(i, source, lang, n, text), leaf_of(i, source, lang, n, shown)))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for rows in by_source.values():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    subroots = [siblings([r[1] for r in by_source[s]], 0)[1] for s in order]
    found = []
    for k, s in enumerate(order):
        for p, (i, leaf, folded) in enumerate(by_source[s]):
            way, subroot = siblings([r[1] for r in by_source[s]], p)
            above, root = siblings(subroots, k)
            for left, right in way + above:
                folded = H(left, folded, right)
            found.append((i, leaf, subroot, root, "".join(a + b for a, b in way + above), folded, folded == root))
    return found


def documents(n, sources, seed=5):
    rng = random.Random(seed)
    docs = [(i, "\n".join(rng.choice(["été", "x" * 40, ""]) for _ in range(3)), rng.choice(["en", None]), rng.choice(sources), rng.choice([7, None])) for i in range(n)]
    docs += [(9000, None, None, "hot", None), (9001, "", "en", "hot", 0), (9002, "long\n" * 50_000, "en", "only", 1), (None, "no\nid", "en", "hot", 2)]
    docs += [(9004, "twice\n", "en", "hot", 3)] * 3 + [(9004, "same id", "en", "hot", 3)]
    rng.shuffle(docs)
    return docs


def result(spark, docs, partitions=5, **settings):
    d = spark.createDataFrame([(*r, 1, "x", 2) for r in docs], SCHEMA).repartition(partitions)
    shown = F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = merkle.proofs(d, {"text": shown}, **settings)
    return sorted((tuple(r) for r in found.select("doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified").collect()), key=str)


@pytest.mark.parametrize("n, sources, block_levels", [(400, ["hot"] * 8 + ["a", "b", None, "é", ""], 1), (400, ["hot", "Z"], 2), (60, [None, *map(str, range(70))], 2), (300, ["hot"], 8)])
def test_as_built_plainly(spark, n, sources, block_levels):
    docs = documents(n, sources)
    assert result(spark, docs, block_levels=block_levels) == sorted(wanted(docs), key=str)


@pytest.mark.parametrize("n", [0, 1, 3, 4])
def test_small_trees(spark, n):
    docs = [(i, "a\nb", "en", "s", 3) for i in range(n)]
    assert result(spark, docs) == sorted(wanted(docs), key=str)


def test_other_partitions_same_root(spark):
    docs = documents(150, ["hot", "b"])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "17")
        assert result(spark, docs, 3, block_levels=1) == sorted(wanted(docs), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_least_set_of_missing_nodes():
    for n in (1, 2, 9, 10, 28, 81, 100):
        count = merkle.sizes(n)
        for start in range(0, n, 4):
            for end in range(start + 1, n + 1, 3):
                got = list(merkle.missing(start, end, n))
                # A node is needed if its parent is above a known leaf, and missing unless it is above one itself.
                want, known = [], set(range(start, end))
                for level, size in enumerate(count[:-1]):
                    above = {p // 3 for p in known}
                    want += [(level, p) for p in range(size) if p // 3 in above and p not in known]
                    known = above
                assert got == want


def test_changed_row_changes_what_it_should(spark):
    docs = documents(50, ["a", "b"])
    other = [(i, "changed", *rest) if i == 7 else (i, t, *rest) for i, t, *rest in docs]
    at = lambda rows: {(r[0], r[1]): r for r in rows}
    a, b = at(result(spark, docs)), at(result(spark, other))
    source = next(r[3] for r in docs if r[0] == 7)
    assert len({r[3] for r in a.values()}) == len({r[3] for r in b.values()}) == 1
    assert all((a[k][2] == b[k][2]) == (d[3] != source) for d in docs if d[0] != 7 and d[0] is not None for k in a if k[0] == d[0])

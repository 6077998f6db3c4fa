"""Secret scans: candidates against plain Python, and what the forest keeps out."""

import hashlib
import random
import re

from regtables.llm import secret_scan as scan

HEX = "0123456789abcdef"


def brute(text):
    found, at = [], 0
    for i, w in enumerate(re.split(r"[ \t\n\x0b\f\r]", text or "")):
        m = re.search(r"[A-Za-z0-9+/_.~-]{16,}", w)
        if m and (re.search("[0-9]", m.group()) or len(m.group()) >= 24):
            found.append((i, at + m.start(), m.group()))
        at += len(w) + 1
    return found


def cases():
    rng = random.Random(8)
    plain = lambda n: " ".join(rng.choice(["the", "river", "runs", "downhill", "été"]) for _ in range(n))
    key = lambda n: "".join(rng.choice(HEX) for _ in range(n))
    docs, true = [], set()
    for i in range(120):
        t = plain(rng.randint(0, 12))
        if i % 3 == 0:
            k = key(40)
            true.add((i, hashlib.sha256(k.encode()).hexdigest()))
            t += f' token = "{k}" ' + plain(3)
        if i % 3 == 1:
            t += f" commit {key(40)}  see river.runs-downhill.example2.com\n" + plain(2)
        if i % 3 == 2:
            t += " " + "riverrunsdownhill" * 2 + " " + "4532015112830366"
        docs.append((i, t, "src/app"))
    return docs, true


def test_candidates_against_brute_force(spark):
    docs, _ = cases()
    docs += [(200, None, None), (201, "", "x"), (None, "\n\nkey=aaaa1111bbbb2222cccc", None), docs[0], (202, "word " * 60_000 + "ab12" * 6, "x")]
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, source string, start int").repartition(5)
    got = sorted(((r.doc_id, r.word_no, r.start, r.value) for r in scan.candidates(d).collect()), key=repr)
    assert got == sorted(((i, *f) for i, t, _ in docs for f in brute(t)), key=repr)


def test_all_runs_of_a_word(spark):
    key, other = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYzz", "0123456789abcdef"
    texts = [
        f"AWS_SECRET_ACCESS_KEY={key}", f"x spring.datasource.password={key} y", f"DefaultEndpointsProtocol=https;AccountName=été;AccountKey={key}==",
        f'{{"id":"{other}","token":"{key}","again":"{key}"}}', f'[{",".join([other] * 50)}]', f"={key}", "a" * 16 + ";" + "b" * 24,
    ]
    wanted = []
    for i, text in enumerate(texts):
        for w in re.finditer(r"\S+", text):
            runs = [m for m in re.finditer(r"[A-Za-z0-9+/_.~-]{16,}", w.group()) if re.search("[0-9]", m.group()) or len(m.group()) >= 24]
            wanted += [(i, w.start() + m.start(), m.group()) for m in runs]
    found = scan.candidates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'app' AS source")).collect()
    assert sorted((r.doc_id, r.start, r.value) for r in found) == sorted(wanted)
    assert {(r.before, r.lead, r.tail, r.after) for r in found if r.doc_id == 1 and r.value == key} == {("x", "spring.datasource.password=", "", "y")}
    assert [r.lead for r in found if r.doc_id == 3 and r.value == key][0] == f'{{"id":"{other}","token":"'


def test_forest_keeps_true_findings_and_drops_others(spark):
    docs, true = cases()
    d = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(4)
    got = scan.secrets(d)
    rows = got.collect()
    assert len(rows) == sum(len(brute(t)) for _, t, _ in docs)
    assert {(r.doc_id, r.value_sha256) for r in rows if r.is_secret} == true
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_coverage_and_lack_of_labels(spark, tmp_path):
    docs = [(i, "deploy deploy river", "s") for i in range(6)] + [(9, "deploy-river-0123456789 zzz", "s")]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = scan.with_features(scan.candidates(d), d, str(tmp_path)).collect()
    assert [r.coverage for r in rows] == [11 / 23]
    assert [(r.score, r.is_secret) for r in scan.secrets(d).collect()] == [(0.0, False)]
    assert scan.secrets(d.limit(0)).collect() == []


def test_many_candidates_in_one_text(spark):
    """Twice the candidates take about twice the time, in many words or in one."""
    import time

    def took(text):
        d = spark.createDataFrame([(1, text, "app")], "doc_id long, text string, source string")
        start = time.perf_counter()
        rows = scan.candidates(d).select("start", "value").collect()
        return rows, time.perf_counter() - start

    key = lambda i: f"k{i:015d}"
    texts = {n: (" ".join(f'x{i % 7} "{key(i)}"' for i in range(n)), ",".join(key(i) for i in range(n))) for n in (100, 5000, 20_000)}
    took(texts[100][0])
    for which in range(2):
        small, large = (took(texts[n][which]) for n in (5000, 20_000))
        for (rows, _), n in ((small, 5000), (large, 20_000)):
            text = texts[n][which]
            assert sorted((r.start, r.value) for r in rows) == [(m.start(), m.group()) for m in re.finditer("k[0-9]{15}", text)]
        assert large[1] < 8 * small[1] + 2


def test_columns_named_like_parts(spark):
    docs = [(1, 'api_key = "abcd1234abcd1234abcd"', "app", 1, "x")]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string, row int, words string")
    assert [(r.start, r.value, r.lead) for r in scan.candidates(d).collect()] == [(11, "abcd1234abcd1234abcd", '"')]

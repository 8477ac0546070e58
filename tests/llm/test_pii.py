import re
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from strataquarry.llm import pii

PLAIN = [re.compile(p) for p in (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain(text):
    ok = (lambda s: True, lambda s: all(int(x) <= 255 for x in s.split(".")), lambda s: 12 <= len(d := re.sub("[ -]", "", s)) <= 19 and pii.luhn(d), lambda s: 9 <= len(re.sub("[^0-9]", "", s)) <= 15)
    return sorted((m.start(), k, m.end()) for k in range(4) for m in PLAIN[k].finditer(text) if ok[k](m[0]))


CASES = ["", "a@b.c", "x a@b@c.d.e. f", "@x.y a@ b@c", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255", "4111 1111 1111 1111 4111-1111-1111-1111", "4111111111111112", "+1 (743) 555-3824 +1 +12345678 +1234567890123456", "ü@ä.de é a.b@c-d.e-f 1.2.3", "0" * 25 + " 0 0 0 0 0 0 0 0 0 0 0 0", "a.b+c@d..e", "x" * 300 + "@y.z"]


def test_base_spans_follow_the_patterns():
    for text in CASES:
        assert pii.base_spans(text) == plain(text), text


def test_long_runs_stay_linear():
    assert pii.base_spans("a" * 200_000 + " " + "1" * 200_000 + " " + "." * 100_000) == []


def test_contexts_discover_identifiers(spark):
    """Seeds after one cue induce it; an identifier no base pattern matches is then found; a rare cue is not enough."""
    data = [(i, f"filler reach me on +1 (555) 010-{1000 + i} later") for i in range(60)] + [(100, "filler reach me on 555-0199x later"), (101, "unrelated code 12345 stays"), (102, None)]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumn("row", F.lit(1))
    got = {r.doc_id: r for r in pii.find_personal_data(df).collect()}
    assert got[100].spans == "phone:19:28" and got[100].n_phone == 0
    assert got[101].spans == "" and got[102].spans == ""
    assert all(got[i].spans == f"phone:19:{19 + len(f'+1 (555) 010-{1000 + i}')}" for i in range(60))
    assert got[5].base_sha256 == pii.digest(pii.base_spans(data[5][1]))


def test_empty_table_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a@b.c"), (1, "a@b.c")], "doc_id long, text string")
    assert [r.spans for r in pii.find_personal_data(df).collect()] == ["email:0:5"] * 2
    assert pii.find_personal_data(df.where("false")).count() == 0


def marked(texts, is_labelled=pii.labelled_text):
    """(labelled, marks) of each text, as the scan gives them."""
    return [(lab := is_labelled(t or ""), pii.marks(t or "", pii.base_spans(t or ""), lab)) for t in texts]


def brute_graph(rows, rounds=None, min_seeds=5, min_score=0.9, smoothing=0.25):
    """Scores of the pattern-instance graph by plain loops: value -> kind of all that end sure."""
    instances, sure_label, seeds = defaultdict(set), set(), set()
    for lab, marks in rows:
        for m in marks:
            for p in m["patterns"]:
                instances[p].add(m["value"])
                if lab:
                    sure_label.add((p, m["value"]))
            if m["kind"] is not None:
                seeds.add((m["value"], m["kind"]))
    score, done, before = dict.fromkeys(seeds, 1.0), 0, -1
    while rounds is None or done < rounds:
        new = dict.fromkeys(seeds, 1.0)
        for p, values in instances.items():
            for kind in range(len(pii.KINDS)):
                own = {v: score[v, kind] for v in values if (v, kind) in score}
                if sum(x >= min_score for x in own.values()) < min_seeds:
                    continue
                if kind == pii.SECRET:
                    counted = {v: x for v, x in own.items() if x >= min_score or (p, v) in sure_label}
                    total = len({v for v in values if (p, v) in sure_label} | {v for v, x in own.items() if x >= min_score})
                    confidence = sum(counted.values()) / (total + smoothing)
                else:
                    confidence = sum(own.values()) / (len(values) + smoothing)
                for v in values:
                    new[v, kind] = max(new.get((v, kind), 0.0), round(confidence, 9))
        score, done = new, done + 1
        sure = sum(x >= min_score for x in score.values())
        if sure == before:
            break
        before = sure
    return {v: min((-s, k) for (w, k), s in score.items() if w == v and s >= min_score)[1] for v in {v for (v, _), s in score.items() if s >= min_score}}


def labelled():
    """Labelled identifiers that no base pattern matches, a second label reached only through values found by the first, and decoys."""
    data = [f"Call tel.: +33 6 12 34 56 {i} now" for i in range(10, 40)] + ["Call tel.: 06 12 34 56 78 now", "Call tel.: (030) 555-1234 now"]
    data += [f'set api_key = "k{i}Zq90x{i * 7}pLm" here' for i in range(60)] + [f"then auth <<k{i}Zq90x{i * 7}pLm>> there" for i in range(40)] + ["then auth <<zz81Qm55Lw0t>> there"]
    data += [f"order number 55 10 20 30 {i} shipped" for i in range(10, 30)] + ["version 1.2.3.456 of it", None, "", "see page 12345"]
    return data


def test_graph_equals_brute_force(spark):
    texts = labelled()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = df.mapInArrow(pii._scanner(pii.LABELLED), pii.FOUND)
    for rounds in (1, 2, None):
        got = {r.value: r.kind for r in pii.induce(found, rounds).collect()}
        assert got == brute_graph(marked(texts), rounds)
    assert "zz81qm55lw0t" not in brute_graph(marked(texts), 1) and brute_graph(marked(texts))["zz81qm55lw0t"] == pii.SECRET


def test_secrets_come_back_without_a_third_of_their_seeds(spark):
    """Only labelled texts see the labeller. With a third of them unlabelled every secret is still found, by its patterns, and no decoy."""
    texts = [f'cfg token = "k{zlib.crc32(str(i).encode()):08x}z{i:04d}a7" end' for i in range(200)] + [f"build number {i:04d}77{i:06d} ok" for i in range(200)]
    secret = {t.split('"')[1] for t in texts if "token" in t}
    third = lambda t: pii.labelled_text(t) and zlib.crc32(t.encode()) // pii.LABELLED % 3 > 0
    for is_labelled in (pii.labelled_text, third):
        rows = marked(texts, is_labelled)
        seeds = {m["value"] for _, marks in rows for m in marks if m["kind"] == pii.SECRET}
        assert 5 < len(seeds) < 80
        found = spark.createDataFrame(rows, "labelled boolean, marks array<struct<start:int,end:int,kind:int,value:string,patterns:array<string>>>")
        assert {r.value for r in pii.induce(found).where(f"kind = {pii.SECRET}").collect()} == secret
    dropped = {m["value"] for (_, marks), (lab, _) in zip(marked(texts), marked(texts, third), strict=True) if not lab for m in marks if m["kind"] == pii.SECRET}
    assert dropped and dropped <= secret


def test_given_seeds(spark):
    """Labelled values from outside, without any labelled text of their own."""
    rows = marked([f"uid is q{i:05d}w7 ok" for i in range(30)], lambda t: False)
    found = spark.createDataFrame(rows, "labelled boolean, marks array<struct<start:int,end:int,kind:int,value:string,patterns:array<string>>>")
    assert pii.induce(found).count() == 0
    some = spark.createDataFrame([(f"Q{i:05d}W7", pii.SECRET) for i in range(10)], "value string, kind int")
    assert {r.value for r in pii.induce(found, seeds=some).collect()} == {f"q{i:05d}w7" for i in range(30)}


def test_labels_are_found_however_far_off():
    far = "Account" + " " * 500 + "12345678"
    assert any(p.startswith("p:") for p in pii.patterns(far, far.index("1"), len(far)))
    assert [p for p in pii.patterns("x" * 5000 + ": 12345678", 5002, 5010) if p.startswith("p:")] != []


def test_spaced_numbers_secrets_and_decoys(spark):
    texts = labelled()
    got = {r.doc_id: r for r in pii.find_personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        row, spans = got[i], [x.split(":") for x in got[i].spans.split(",") if x]
        if t and "tel.:" in t:
            assert [k for k, *_ in spans] == ["phone"] and t[int(spans[0][1]) : int(spans[0][2])].endswith(t.split(" now")[0][-4:])
        elif t and ("api_key" in t or "auth" in t):
            assert [k for k, *_ in spans] == ["secret"]
        else:
            assert not spans, t
        assert (row.n_added, row.n_spans) == (len(spans) - len(pii.base_spans(t or "")), len(spans))


def test_ties_long_texts_and_clashing_columns(spark):
    cue = [f"id# +1 (555) 010-{1000 + i} end" for i in range(30)] + [f"id# a{i}@mail.example.org end" for i in range(30)]
    long = "1 " * 60_000 + "x" * 200_000 + " 77a88b99c00d " + "y" * 200_000 + " @" * 30_000 + " 12 34" * 20_000
    rows = [(i, t, "r", 1, "m") for i, t in enumerate([*cue, "id# 555-0199x end", long])]
    out = {r.doc_id: r for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string, row string, kind int, marks string"), min_score=0.4).collect()}
    assert out[60].spans.startswith("email:")  # both kinds score alike; the first as listed
    assert out[61].n_email == 0 and out[61].spans == ""

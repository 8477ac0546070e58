from collections import Counter

from pyspark.sql import functions as F

from strataquarry.llm import line_dedup


def brute(data, ratio, sure):
    total, pages = Counter(h for _, _, h in data), Counter()
    for _, t, h in data:
        for x in {y.strip(" ") for y in (t or "").split("\n")} - {""}:
            pages[h, x] += 1
    above = {k: n - ratio * total[k[0]] for k, n in pages.items()}
    goes = {k for k, n in pages.items() if n > 1 and above[k] > 0 and above[k] ** 2 > sure**2 * ratio * (1 - ratio) * total[k[0]]}
    out = []
    for i, t, h in data:
        lines = (t or "").split("\n")
        kept = [x for x in lines if x.strip(" ") == "" or (h, x.strip(" ")) not in goes]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def test_equals_brute_force(spark):
    data = [(i, f"menu\nstory {i}\n  menu \n\nrare {i % 9}", "a" if i % 2 else None) for i in range(40)]
    data += [(100, None, "a"), (101, "", "b"), (102, "menu", "b"), (103, "menu", "")] + [(200 + i, "only\nonly", "c") for i in range(6)] + [(200, "only\nonly", "c")]
    df = spark.createDataFrame(data, "doc_id long, text string, source string").withColumns({"h": F.lit(1), "total": F.lit(2), "pages": F.lit(3)})
    got = sorted((r.doc_id, r.text, r._lines, r._dropped) for r in line_dedup.without_boilerplate(df, ratio=0.5, sure=1.0).collect())
    assert got == sorted(brute(data, 0.5, 1.0))
    assert any(r[1] == "" and r[3] == 2 for r in got)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert line_dedup.without_boilerplate(df).count() == 0


def test_hosts_of_every_size(spark):
    """One rule: 2 of 4 pages go, 2 of 50 stay; a line on a host's only page stays."""
    data = [(i, f"footer\nown {i}", "small") for i in range(2)] + [(i, f"own {i}", "small") for i in (2, 3)]
    data += [(10 + i, f"{'pair' if i < 2 else 'x'} {i // 2}\nfooter" if i < 10 else f"own {i}", "large") for i in range(50)] + [(99, "footer", "single")]
    got = {r.doc_id: (r.text, r._dropped) for r in line_dedup.without_boilerplate(spark.createDataFrame(data, "doc_id long, text string, source string")).collect()}
    assert got == {i: (t, n) for i, t, _, n in brute(data, line_dedup.RATIO, line_dedup.SURE)}
    assert got[0] == ("own 0", 1) and got[99] == ("footer", 0) and got[10] == ("pair 0", 1)


def test_clashing_names_and_long_texts(spark):
    names = ["h", "absent", "hashes", "kept", "_kept", "_hashes", "parity", "_lines"]
    rows = [(i, "menu\n" + f"line {i}\n" * 30_000, "s", *range(8)) for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{n} long" for n in names))
    out = line_dedup.without_boilerplate(df, into=("n", "gone")).collect()
    assert all([r[n] for n in names] == list(range(8)) and (r.n, r.gone) == (30_002, 1) for r in out)
    replaced = line_dedup.without_boilerplate(df)
    assert replaced.columns.count("_lines") == 1 and replaced.first()._lines == 30_002

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strataquarry.operators import rewrite, search, texts


@pytest.mark.parametrize(
    "pattern, want",
    [
        ("example\\.com", ["example.com"]), ("ab?cd+e", ["a", "cd", "e"]), ("ab{0,2}c", ["a", "c"]), ("a|b", []), ("(a|b)cde", ["cde"]), ("x[ab]*yz", ["x", "yz"]),
        ("\\bdef\\s+run", ["def", "run"]), ("(?i)abc", []), ("\\Qa.b\\E", []), ("\\x41bc", []), ("[^]a]bcd", ["bcd"]), ("a[b[c]]d", []), ("\\.*abc", ["abc"]), ("", []), ("^abc$", ["abc"]), ("(abc)?d", ["d"]), ("a*?bc", ["bc"]),
    ],
)
def test_required(pattern, want):
    assert search.required(pattern) == want


@settings(max_examples=300, deadline=None)
@given(st.text("ab.+?*()[]{1}|^\\", max_size=8), st.text("ab.(1", max_size=12))
def test_what_is_required_stands_in_every_match(pattern, text):
    try:
        found = re.search(pattern, text)
    except (re.error, OverflowError):
        return
    if found:
        assert all(r in found.group() for r in search.required(pattern)), search.required(pattern)


def test_search_equals_grep_and_reads_less(spark, tmp_path):
    rows = [(f"f{i}", f"line one\ncall_{i % 7}(x)\n" + "é😀xy\n" * (i % 3)) for i in range(60)] + [("none", None), ("empty", ""), ("split", "call\n_3"), ("short", "ab")]
    files = spark.createDataFrame(rows, "path string, content string")
    search.write_index(files, str(tmp_path / "i"))
    index = search.read_index(spark, str(tmp_path / "i"))
    for pattern in ("call_3", "call_[35]\\(", "😀x", "é😀", "x|y", "^ab$", "nothing here", "ca.l_3\\(x\\)$", "(?i)CALL_3"):
        want = [tuple(r) for r in texts.grep(files, pattern, 1 << 20).collect()]
        assert sorted(tuple(r) for r in search.search(files, index, pattern).collect()) == want, pattern
    assert tuple(search.search_cost(files, index, "call_3").first()) == (64, 9, 9)
    assert tuple(search.search_cost(files, index, "x|y").first())[:2] == (64, 64)
    assert "PushedFilters: [In(gram" in search.candidates(index, "call_3")._jdf.queryExecution().toString()


def test_windows(spark):
    files = spark.createDataFrame([("a", "1\n2\n3"), ("b", ""), ("c", None)], "path string, content string")
    asked = spark.createDataFrame([("a", 2), ("a", 2), ("a", None), ("a", 9), ("b", 1), ("c", 1), ("no", 1)], "path string, start int")
    got = {(r.path, r.start): (r.text, r.end, r.of, r.truncated) for r in texts.read_windows(files, asked, 2, 3).collect()}
    assert got[("a", 2)] == ("2\n3", 3, 3, False) and got[("a", 1)] == ("1\n2", 2, 3, True) and got[("a", 9)] == ("", 3, 3, False) and got[("b", 1)] == ("", 1, 1, False)
    assert ("no", 1) not in got


def test_names_of_one_task_stay_in_it(spark):
    files = spark.createDataFrame([(1, "a.py", "_x _y"), (2, "b.py", "_x _y"), (3, "c.py", "_x")], "task int, path string, content string")
    names = spark.createDataFrame([(1, "_x"), (2, "_y")], "task int, name string")
    got = {r.task: (r.content, r.changed) for r in rewrite.rename_private(files, names, keys=("task",)).collect()}
    assert got == {1: ("_x_alt _y", True), 2: ("_x _y_alt", True), 3: ("_x", False)}

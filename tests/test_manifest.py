"""The manifest data source: ranges, order, repeats, files that cannot be read."""

import io

import pytest
from hypothesis import given, settings, strategies as st

from termflow.sources.manifest import lines_from, listed_files
from termflow.sources.text import manifest_documents


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "bc", "", "d\u00e9f", "g" * 9000, "h\r"]), max_size=8), st.booleans(),
       st.integers(1, 40))
def test_each_line_is_in_one_range(lines, last_end, size):
    raw = "\n".join(lines).encode() + (b"\n" if last_end and lines else b"")
    whole, at = [], 0
    for line in raw.split(b"\n"):
        if at < len(raw):
            whole.append((at, line.removesuffix(b"\r")))
        at += len(line) + 1
    step = size if len(raw) < 1000 else 997 * size
    got = [x for b in range(0, len(raw), step) for x in lines_from(io.BytesIO(raw), b, min(b + step, len(raw)))]
    assert got == whole


def test_order_repeats_and_unreadable_files(spark, tmp_dir):
    names = []
    for i in range(60):
        names.append(f"{tmp_dir}/f{i}.txt")
        with open(names[-1], "wb") as f:
            f.write(b"" if i == 7 else b"\xff bad" if i == 8 else f"text {i}\r\nend".encode())
    listed = [*names, names[3], "", f"{tmp_dir}/none.txt", f"file:{names[4]}", f"file://{names[5]}", tmp_dir]
    with open(f"{tmp_dir}/manifest.txt", "w") as f:
        f.write("\n".join(listed))
    found = listed_files(spark, f"{tmp_dir}/manifest.txt", range_bytes=100)
    assert found.rdd.getNumPartitions() > 10
    rows = found.orderBy("line_at").collect()
    assert [r.doc_name for r in rows] == [n for n in listed if n]
    of = {r.doc_name: r for r in rows}
    assert of[names[7]].value == "" and of[names[8]].value == "\ufffd bad"
    assert of[f"file:{names[4]}"].value == of[names[4]].value == "text 4\r\nend"
    assert of[f"file://{names[5]}"].value == "text 5\r\nend"
    bad = {r.doc_name for r in rows if r.error is not None}
    assert bad == {f"{tmp_dir}/none.txt", tmp_dir} == {r.doc_name for r in rows if r.value is None}
    docs = manifest_documents(spark, f"{tmp_dir}/manifest.txt")
    assert docs.count() == len(rows) and docs.where("content = 'text 3 end '").count() == 2


def test_same_rows_for_all_range_sizes(spark, tmp_dir):
    with open(f"{tmp_dir}/a.txt", "w") as f:
        f.write("x")
    with open(f"{tmp_dir}/manifest.txt", "w") as f:
        f.write(f"{tmp_dir}/a.txt\n" * 50)
    counts = {listed_files(spark, f"{tmp_dir}/manifest.txt", range_bytes=n).select("line_at", "value").distinct().count()
              for n in (7, 64, 1 << 20)}
    assert counts == {50}


def test_empty_and_missing_manifest(spark, tmp_dir):
    open(f"{tmp_dir}/empty.txt", "w").close()
    assert listed_files(spark, f"{tmp_dir}/empty.txt").count() == 0
    with pytest.raises(Exception, match="no manifest"):
        listed_files(spark, f"{tmp_dir}/gone.txt").count()

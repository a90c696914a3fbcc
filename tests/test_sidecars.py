"""Sidecars are listed and read in tasks."""

import os

from docpulse.sources.sidecars import read_sidecars


def test_no_sidecar_goes_through_the_driver(spark, folder):
    want = {}
    for path, text in [(f"rejected/u {i % 3}/a+b/{i}%.report.json", f"text {i} é") for i in range(40)] + [
            ("top.error.txt", "t"), ("a/b/c/d/deep.error.txt", "line\r\nline\n"), ("empty.error.txt", ""), ("a/other.json", "x"), ("a/_x/no.error.txt", "x"),
            ("_staged/j/no.report.json", "x"), (".no.error.txt", "x"), ("a/_k=1/yes.error.txt", "k")]:
        os.makedirs(os.path.dirname(f"{folder}/s/{path}"), exist_ok=True)
        with open(f"{folder}/s/{path}", "w", newline="") as file:
            file.write(text)
        if text and "no." not in path and "other" not in path:
            want[path] = text
    with open(f"{folder}/s/odd.error.txt", "wb") as file:
        file.write(b"\xff\xfe")
    got = read_sidecars(spark, f"{folder}/s")
    assert not [f for f in got.inputFiles() if f.endswith((".error.txt", ".report.json"))]
    found = got.selectExpr("path", "cast(text as binary) AS text").collect()
    assert {r.path: bytes(r.text) for r in found} == {**{p: t.encode() for p, t in want.items()}, "odd.error.txt": b"\xff\xfe"} and len(found) == len(want) + 1

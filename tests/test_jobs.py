import os

from pyspark.sql import functions as F

from sheafline.plans import jobs


def put(root, name, data):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode())
    return path


def test_reclean(spark, tmp_path):
    root = str(tmp_path)
    a, b, bad = put(root, "a.md", "Scanned with CamScanner\n## Trang 2\nbước &rarr; hai\n"), put(root, "sub/b.txt", "hai"), put(root, "bad.md", b"\xff\xfe")
    put(root, "c.pdf", b"%PDF")
    plan = {r.path: r.status for r in jobs.reclean(spark, root, dry_run=True).collect()}
    assert plan == {a: "planned", b: "planned", bad: "error"} and not os.path.exists(f"{root}/a_rag_clean.md")
    done = {r.path: (r.status, r.message) for r in jobs.reclean(spark, root).collect()}
    assert done == {a: ("written", ""), b: ("written", ""), bad: ("error", "not UTF-8")}
    assert open(f"{root}/a_rag_clean.md").read() == "<!-- page: 2 -->\nbước → hai\n"
    assert {r.status for r in jobs.reclean(spark, root).where(F.col("path") != bad).collect()} == {"skipped"}
    assert {r.status for r in jobs.reclean(spark, root, force=True).where(F.col("path") != bad).collect()} == {"written"}


def test_metadata(spark, tmp_path):
    docs, sources = str(tmp_path / "docs"), str(tmp_path / "in")
    plain, told = put(docs, "quy_dinh_structured.md", "body\n"), put(docs, "other.md", "---\nsource_file: PDFs/x.pdf\ntitle: T\n---\n\nbody\n")
    put(sources, "PDFs/quy dinh.pdf", b"one")
    put(sources, "PDFs/x.pdf", b"two")
    now = F.lit("2024-01-01T00:00:00+00:00")
    jobs.apply_metadata(spark, docs, sources, now)
    text = open(plain).read()
    assert "source_file: \"PDFs/quy dinh.pdf\"" in text and "checksum: f97c5d29941bfb1b2fdab0874906ab82" in text and text.endswith("---\n\nbody\n")
    assert "checksum: b8a9f715dbb64fd5c56e7783c6820a61" in open(told).read()


def test_validate(spark, tmp_path, capsys):
    put(str(tmp_path), "none.md", "no head")
    put(str(tmp_path), "bad.md", b"\xff")
    assert jobs.main(["validate", str(tmp_path)], spark) == 1 and "ERROR: 2" in capsys.readouterr().out


def test_exit_state(spark):
    state = lambda *x: spark.createDataFrame([(v,) for v in x], "status string")
    assert jobs.exit_state(state("OK", "WARN")) == 0 and jobs.exit_state(state("OK", "WARN"), strict=True) == 1
    assert jobs.exit_state(state("OK", "ERROR")) == 1 and jobs.exit_state(state(), strict=True) == 0


def test_parsed_answers(spark):
    rows = [("/in/a b.pdf", "<!-- page: 1 -->\n\nNội dung"), ("/in/c.pdf", None), ("/in/d.pdf", "<!-- page: 1 -->")]
    got = {r.path: r for r in jobs.save_parsed(spark.createDataFrame(rows, "source_path string, markdown string"), "/out", now=F.lit("t")).collect()}
    assert got["/in/a b.pdf"].out_path == "/out/a_b_structured.md" and "parser: remote" in got["/in/a b.pdf"].text and got["/in/a b.pdf"].problem is None
    assert got["/in/c.pdf"].problem == got["/in/d.pdf"].problem == "the answer has no text"

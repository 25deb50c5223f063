from siftwell import cli


def test_stages_in_a_row(spark, sf, tmp_path):
    a, b, c = (str(tmp_path / x) for x in "abc")
    lines = tmp_path / "lines.txt"
    lines.write_text("".join(f"__label__{x} {t} number{i}\n" for i in range(30) for x, t in (("en", "the council and the harbour of this town"), ("de", "der Hafen und die Gemeinde der Stadt"), ("fr", "le port et la mairie de cette ville"))))
    model = str(tmp_path / "lang.npz")
    cli.main(["train", "--input", str(lines), "--output", model, "--kind", "chars", "--buckets", "4096"])
    cli.main(["stage1", "--input", f"{sf}/documents.parquet", "--output", a, "--language_model", model])
    cli.main(["stage2", "--input", a, "--output", b])
    cli.main(["stage3", "--input", b, "--output", c])
    n = spark.read.parquet(b).count()
    assert 0 < n <= spark.read.parquet(a).count()
    assert spark.read.text(b + "_lines").count() == n
    ids = [x for f in sorted((tmp_path / "c").glob("*.bin")) for x in f.read_bytes()]
    assert len(ids) % 2 == 0 and len(ids) > 2 * n


def test_archive_to_documents(spark, tmp_path):
    body = "plain text".encode()
    (tmp_path / "x.wet").write_bytes(b"WARC/1.0\r\nWARC-Type: conversion\r\nWARC-Target-URI: http://a.example/\r\nContent-Length: " + str(len(body)).encode() + b"\r\n\r\n" + body + b"\r\n\r\n")
    rows = cli.read_documents(spark, str(tmp_path), "wet").collect()
    assert [(r.text, r.url) for r in rows] == [("plain text", "http://a.example/")]


def test_archives_through_stage1_with_audit(spark, tmp_path):
    text = ("the report and the study of that council have to be read with care " * 8).encode()
    rec = b"WARC/1.0\r\nWARC-Type: conversion\r\nWARC-Target-URI: http://a.example/\r\nContent-Length: " + str(len(text)).encode() + b"\r\n\r\n" + text + b"\r\n\r\n"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.wet").write_bytes(rec + rec + b"cut off")
    out = str(tmp_path / "out")
    cli.main(["stage1", "--format", "wet", "--input", str(tmp_path / "in"), "--output", out, "--no_super_quality", "--min_words", "1"])
    got = spark.read.parquet(out).collect()
    assert len({r.doc_id for r in got}) == len(got)
    audit = spark.read.parquet(out + "_audit").collect()
    assert [(r.records, r.broken, r.kept) for r in audit] == [(2, 1, len(got))]

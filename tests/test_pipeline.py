import json

import pytest

from corpusmill.__main__ import main
from corpusmill.plans import pipeline
from corpusmill.sources import files, sinks


@pytest.fixture
def corpus(tmp_path):
    d = tmp_path / "in"
    (d / "deep").mkdir(parents=True)
    (d / "a.md").write_text("# A\n" + "words of a text that is long enough to stay. " * 12)
    (d / "deep" / "b.html").write_text("<title>Page</title><p>" + "words of a page that is long enough to stay. " * 12 + "</p>")
    (d / "c.bin").write_bytes(b"\x00\x01")
    lines = [json.dumps({"content": "a line of its own " * 15, "metadata": {"year": "2020"}}), "", "not json", "5", json.dumps({"metadata": {}}), json.dumps({"content": "a line of its own " * 15})]
    (d / "d.jsonl").write_text("\n".join(lines))
    return str(d)


def test_jsonl(spark, corpus):
    good, bad = files.read_jsonl(spark, corpus)
    assert good.count() == 2 and {r["bad"] for r in bad.collect()} == {"no JSON object", "no content"}
    assert good.where("metadata is not null").first()["metadata"] == '{"year":"2020"}'
    assert files.read_jsonl(spark, corpus, strict=True)[0].count() == 0
    assert files.read_jsonl(spark, "/nowhere")[0].count() == 0


def test_files(spark, corpus):
    assert {r["file_format"] for r in files.read_files(spark, [corpus, "/nowhere"]).collect()} == {"md", "html", "bin"}
    assert files.read_text(spark, corpus).count() == 1


def test_run(spark, corpus, tmp_path):
    out = str(tmp_path / "out")
    stages = [{"name": "deduplication", "config": {"method": "exact"}}, {"name": "length_filter", "config": {"length": 20}}, {"name": "metadata", "config": None}, {"name": "chunker", "config": {"max_chunk_size": 60}}, {"name": "export", "config": {"format": "jsonl", "destination": out}}]
    done = pipeline.run(spark, {"pipeline": {"batch_size": 10, "inputs": {"path": [corpus]}, "stages": stages}})
    assert done.documents.select("doc_id").distinct().count() == 3 and done.bad_lines.count() == 3
    written = spark.read.text(out)
    assert written.count() == done.documents.count() and {r["stem"] for r in written.select("stem").distinct().collect()} == {"a", "b", "d"}


def test_lsh_and_upload_stages(spark, corpus, tmp_path):
    points = str(tmp_path / "points")
    stages = [{"name": "duplication", "config": {"method": "lsh", "shingle_size": 5, "num_perm": 64, "threshold": 0.85}}, {"name": "qdrant", "config": {"vector_store": {"path": points, "vector_size": 16}}}, {"name": "export", "config": {"format": "dummy"}}]
    config = {"pipeline": {"inputs": {"path": corpus}, "stages": stages}}
    pipeline.run(spark, config)
    pipeline.run(spark, config)
    assert spark.read.parquet(points).count() == 3


def test_resume(spark, corpus, tmp_path):
    out = str(tmp_path / "out")
    config = {"pipeline": {"inputs": {"path": corpus}, "stages": [{"name": "export", "config": {"output_dir": out, "format": "jsonl", "resume": True, "mode": "append"}}]}}
    pipeline.run(spark, config)
    first = spark.read.text(out + "/stem=a").count()
    again = pipeline.run(spark, config)
    assert again.documents.count() == 0 and spark.read.text(out + "/stem=a").count() == first == 1


def test_wrong_stages():
    with pytest.raises(ValueError):
        pipeline.checked([{"name": "ingestion"}])
    assert pipeline.checked([{"name": "chunking", "config": None}]) == [("chunker", {})]


def test_own_stage(spark):
    pipeline.register("first_word", lambda df, c: df.limit(c["n"]))
    try:
        assert pipeline.build(spark.range(5), [{"name": "first_word", "config": {"n": 2}}]).count() == 2
    finally:
        del pipeline.STAGES["first_word"]


def test_export_formats(spark, tmp_path):
    d = spark.createDataFrame([("x/a.md", "md", 'say "hi"')], "file_path string, file_format string, content string")
    sinks.export(d, str(tmp_path / "q"), json_quoted=True)
    assert spark.read.text(str(tmp_path / "q")).first()["value"] == '"say \\"hi\\""'
    sinks.export(d, str(tmp_path / "j"), "jsonl")
    assert spark.read.text(str(tmp_path / "j")).first()["value"] == '{"content":"say \\"hi\\"","file_path":"x/a.md","file_format":"md"}'


def test_command_line(spark, corpus, tmp_path):
    import yaml

    out = str(tmp_path / "cli")
    path = tmp_path / "config.yaml"
    path.write_text(yaml.safe_dump({"pipeline": {"inputs": {"path": corpus}, "stages": [{"name": "export", "config": {"output_dir": out}}]}}))
    main(["run", "--config", str(path)])
    assert spark.read.text(out).count() > 0
    main(["clean", corpus, "--output-dir", str(tmp_path / "clean"), "--processors", "ocr", "rules"])
    assert spark.read.text(str(tmp_path / "clean")).count() > 0


def test_stream(spark, corpus, tmp_path):
    from corpusmill.streaming import files as streams

    out = str(tmp_path / "stream")
    for _ in range(2):  # the second run finds nothing new
        docs = streams.without_repeats(streams.jsonl_stream(spark, corpus))
        streams.start(docs, [{"name": "length_filter", "config": {"length": 5}}], out, str(tmp_path / "check")).awaitTermination()
        assert spark.read.option("recursiveFileLookup", "true").text(out).count() == 1


def test_services():
    import http.server
    import threading

    from corpusmill import services

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            data = self.rfile.read(int(self.headers["Content-Length"]))
            if self.path == "/v1/embeddings":
                n = len(json.loads(data)["input"])
                body = {"data": [{"index": i, "embedding": [float(i)]} for i in reversed(range(n))]}
            elif self.path == "/predict":
                body = {"success": True, "anonymized_text": "masked"}
            elif self.path == "/predict/":
                body = "pdf text " + str(b"%PDF" in data)
            else:
                body = {"choices": [{"message": {"content": "```latex\n\\frac{a}{b}\n```"}}]}
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps(body).encode())

        def log_message(self, *a):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}"
    try:
        assert services.remote_embedder(url, "m")(["a", "b"]) == [[0.0], [1.0]]
        assert services.masking_service(url)("text") == "masked"
        assert services.pdf_service(url)(b"%PDF") == "pdf text True"
        assert services.correction_service(url + "/chat", "k", "m")(r"\frac{a", "brace", "x") == r"\frac{a}{b}"
    finally:
        server.shutdown()
    assert services.post_json("http://127.0.0.1:9/none", {}, 1, tries=1) is None


def test_counts_by_stage(spark, corpus, tmp_path):
    stages = [{"name": "cleaning"}, {"name": "metadata"}, {"name": "length_filter", "config": {"length": 10**6}}, {"name": "export", "config": {"output_dir": str(tmp_path / "o")}}]
    done = pipeline.run(spark, {"pipeline": {"inputs": {"path": corpus}, "stages": stages}})
    got = done.counts
    assert [c["stage"] for c in got] == ["input", "cleaning", "metadata", "length_filter"]
    assert got[0]["rows"] == got[1]["rows"] > 0 and got[3]["rows"] == 0 and got[3]["kept_percent"] == 0.0
    assert got[1]["duplicates_removed"] >= 0 and got[2]["md_rows"] + got[2]["html_rows"] <= got[2]["rows"]


def test_services_in_their_stages(spark, tmp_path, monkeypatch):
    """LaTeX correction, OCR sidecars and look-ups run in the stages, and a failed masking leaves no text."""
    from corpusmill import services

    monkeypatch.setattr(services, "correction_service", lambda *a: lambda formula, problem, text: r"\frac{a}")
    monkeypatch.setattr(services, "masking_service", lambda *a: lambda text: None if "secret" in text else "masked")
    monkeypatch.setattr(services, "get_json", lambda url: lambda path: {"message": {"title": ["Found"], "DOI": "10.1000/abc"}})
    d = spark.createDataFrame([("x/a.pdf", "pdf", r"see $\frac{a$"), ("x/b.md", "md", "secret text")], "file_path string, file_format string, content string")
    got = pipeline.build(d, [{"name": "cleaning", "config": {"enable_latex_correction": True, "latex_service": {"url": "u"}}}]).orderBy("file_path").collect()
    assert got[0]["content"] == r"see $\frac{a}$" and got[0]["cleaning"]["latex_corrections_made"] == 1 and got[1]["cleaning"]["latex_errors_found"] == 0
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "a.md").write_text("text doi 10.1000/abc more")
    (tmp_path / "a" / "a_content_list.json").write_text('[{"text": "A Title", "text_level": 1}]')
    rows = pipeline.build(d, [{"name": "metadata", "config": {"sidecars": str(tmp_path), "crossref_url": "u"}}]).orderBy("file_path").collect()
    assert rows[0]["layout_title"] == "A Title" and rows[0]["bibliography"]["title"] == "Found" and rows[1]["layout_title"] == "NA"
    for on_error, n in (("keep", 2), ("drop", 1)):
        masked = pipeline.build(d, [{"name": "pii", "config": {"url": "u", "on_error": on_error}}]).orderBy("file_path").collect()
        assert len(masked) == n and masked[0]["content"] == "masked" and masked[0]["pii_error"] is None
        assert n == 1 or (masked[1]["content"] is None and masked[1]["pii_error"])

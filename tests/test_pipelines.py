import http.server
import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from corpusloom import cli, settings
from corpusloom.operators import chat
from corpusloom.plans import cpt, dialect, qa
from corpusloom.settings import CptSettings, Endpoint, QaSettings
from corpusloom.streaming.chunks import stream_chunks


def rewriter(prompt, step):
    kind, text = prompt.split(":", 1)
    if kind == "BULLET":
        return "" if "bad" in text else f"bullet:{text}"
    return f"reconstructed {text.split(':', 1)[1]}"


def cpt_settings(out, **more):
    prompts = {"to_bullet_points_prompt": "BULLET:{text}", "bullet_points_to_text_prompt": "RECON:{text}"}
    return CptSettings(**{"include_title": False, "min_chars": 1, "max_chars": 1000, "overlap_chars": 0, "train_ratio": 1.0, "shuffle": False, "deduplicate": False, "copyright_mitigation": True, "prompts": prompts, "output_path": str(out)} | more)


def source(tmp_path, names):
    (tmp_path / "in").mkdir(exist_ok=True)
    (tmp_path / "in" / "a.jsonl").write_text("\n".join(json.dumps({"id": n, "title": n, "content": n}) for n in names))
    return str(tmp_path / "in")


def lines(spark, path, schema="text string, id string, copyright_mitigation boolean, cpt_generator string, failed_step string, chunk_index int, error string"):
    return sorted(spark.read.json(str(path), schema=schema).collect(), key=lambda r: r["id"])


def keys(spark, path):
    return sorted(r["value"] for r in spark.read.text(str(path)).collect())


def test_rewrite_saves_both(spark, tmp_path):
    stats = cpt.build(spark, source(tmp_path, ["slow", "fast"]), cpt_settings(tmp_path / "out"), chat.FakeChat(rewriter))
    got = lines(spark, tmp_path / "out" / "all.jsonl")
    assert [(r["text"], r["cpt_generator"], r["copyright_mitigation"]) for r in got] == [("reconstructed fast", "fake-model", True), ("reconstructed slow", "fake-model", True)]
    assert keys(spark, tmp_path / "out" / "processed_ids.txt") == ["fast", "slow"] and stats["chunks"] == 2 and stats["validation_chunks"] == 1


def test_one_bad_candidate(spark, tmp_path):
    out = tmp_path / "out"
    cpt.build(spark, source(tmp_path, ["bad", "fast"]), cpt_settings(out), chat.FakeChat(rewriter))
    (bad,) = lines(spark, out / "all.failures.jsonl")
    assert (bad["id"], bad["chunk_index"], bad["failed_step"]) == ("bad", 0, "to_bullet_points")
    assert keys(spark, out / "processed_ids.txt") == ["fast"]


def test_original_policy_and_no_mitigation(spark, tmp_path):
    out = tmp_path / "out"
    cpt.build(spark, source(tmp_path, ["bad", "fast"]), cpt_settings(out, copyright_failure_policy="original"), chat.FakeChat(rewriter))
    got = {r["id"]: r for r in lines(spark, out / "all.jsonl")}
    assert (got["bad"]["text"], got["bad"]["copyright_mitigation"], got["bad"]["cpt_generator"]) == ("bad", False, None)
    assert keys(spark, out / "processed_ids.txt") == ["bad", "fast"] and not lines(spark, out / "all.failures.jsonl")
    plain = tmp_path / "plain"
    cpt.build(spark, source(tmp_path, ["plain text"]), cpt_settings(plain, copyright_mitigation=False))
    assert "cpt_generator" not in "".join(r["value"] for r in spark.read.text(str(plain / "all.jsonl")).collect())


def test_rerun_adds_nothing(spark, tmp_path):
    out = cpt_settings(tmp_path / "out", copyright_mitigation=False, deduplicate=True, min_chars=2)
    path = source(tmp_path, ["one", "two", "one", "x"])
    first = cpt.build(spark, path, out)
    second = cpt.build(spark, path, out)
    assert first["chunks"] == second["chunks"] == 2
    source(tmp_path, ["one", "two", "three"])
    assert cpt.build(spark, path, out)["chunks"] == 3


QA = {"question_prompt": "Q:{text}|{random_token}", "answer_prompt": "A:{text}", "thinking_prompt": "T:{text}", "refine_answer_prompt": "R:{text}|{question}|{think}|{answer}", "eval_prompt": "E:{answer}"}


def answers(refined):
    def reply(prompt, step):
        text = prompt[2:].split("|")[0]
        if step == 2 and "bad" in text:
            return ""
        return {1: f"<question>{text}?</question>", 2: f"x<answer>{text}!</answer>", 3: f"<think>{text} thinking</think>", 4: refined(prompt, text) if step == 4 else "", 5: "<eval>5</eval>"}[step]

    return reply


def qa_outcome(spark, texts, refined, prompts=QA):
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "id string, text string, chunk_index int") if texts else None
    return qa.outcomes(qa.items(df, ["chunk_index"]), QaSettings(prompts=prompts), chat.FakeChat(answers(refined)))


def test_qa_chain(spark):
    seen = "<think>new</think><answer>better</answer>"
    out = qa_outcome(spark, ["slow", "bad", "fast"], lambda p, t: seen if "slow" in t else f"only {p.split('|')[2]} {p.split('|')[3]}").persist()
    got = {r["id"]: r for r in qa.results(out, "m").collect()}
    assert sorted(got) == ["0", "2"] and [r["item_id"] for r in qa.results(out, "m").collect()] == [0, 2]
    assert (got["0"]["thinking"], got["0"]["answer"], got["0"]["eval"]) == ("new", "better", "5")
    assert (got["2"]["thinking"], got["2"]["answer"]) == ("fast thinking", "only fast thinking fast!")
    assert got["0"]["messages"][1]["content"] == "<think>new</think>\n\nbetter"
    (bad,) = qa.failures(out, "m").collect()
    assert (bad["failed_step"], bad["error"], bad["previous_outputs"], bad["chunk_index"]) == (2, "Step 2 returned empty answer.", {"question": "bad?"}, 1)


def test_qa_optional_steps(spark):
    out = qa_outcome(spark, ["a"], lambda p, t: "", {k: QA[k] for k in ("question_prompt", "answer_prompt")})
    assert qa.results(out, "m").first()["thinking"] == "" and qa.results(out.limit(0), "m").count() == 0
    assert qa_outcome(spark, ["a"], lambda p, t: "", {}).first()["failed_step"] == 1


def test_qa_files_resume(spark, tmp_path):
    out = QaSettings(prompts=QA, output_path=str(tmp_path / "out"))
    for _ in range(2):
        qa.generate(spark, source(tmp_path, ["bad", "fast"]), "content", out, chat.FakeChat(answers(lambda p, t: "r")))
    assert spark.read.json(str(tmp_path / "out" / "rows.jsonl")).count() == 1
    assert keys(spark, tmp_path / "out" / "processed_keys.txt") == ["fast"]


def test_qa_groups(spark, tmp_path):
    """Texts by their folder, records by their file; an id that is missing is the same in every run."""
    for book in ("one", "two"):
        (tmp_path / "in" / book).mkdir(parents=True)
        (tmp_path / "in" / book / "t.txt").write_text(f"text {book}")
    (tmp_path / "in" / "r.jsonl").write_text('{"content": "record"}')
    out = QaSettings(prompts=QA, output_path=str(tmp_path / "out"))
    for _ in range(2):
        n = qa.generate(spark, f"file://{tmp_path}/in", "content", out, chat.FakeChat(answers(lambda p, t: "r")))
        (tmp_path / "in" / "a.jsonl").write_text('{"content": ""}')
    assert n["completed"] == 0
    got = spark.read.json(str(tmp_path / "out" / "rows.jsonl"))
    assert sorted((r["group"], r["question"]) for r in got.collect()) == [("one", "text one?"), ("r", "record?"), ("two", "text two?")]


def sleepy(prompt, step):
    time.sleep(1.5 if prompt == "slow" else 0.05)
    return prompt


def test_calls_at_a_time(spark):
    """Several calls run together within the cap, and quick rows don't wait for a slow one."""
    df = spark.createDataFrame([("slow",)] + [("quick",)] * 40, "p string").repartition(8)
    counters = chat.RunCounters(spark)
    out = chat.run_chain(df, chat.FakeChat(sleepy), lambda c, row: {"a": c.complete(row["p"]), "at": time.time()}, "a string, at double", 6, counters)
    rows = out.collect()
    n = counters.as_dict()
    assert n["completed"] == 41 and n["failed"] == 0 and 2 <= n["max_in_flight"] <= 6
    slow = next(r["at"] for r in rows if r["a"] == "slow")
    assert sum(r["at"] < slow for r in rows) >= 35


def failing(prompt, step):
    if prompt == "broken":
        raise RuntimeError("a bug")
    return prompt


def test_killed_run_repeats_no_saved_call(spark, tmp_path):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(40)] + [(None, "x"), (None, "x")], "i int, p string")
    chain = lambda c, row: {"a": c.complete(row["p"])}
    path, first, second = str(tmp_path / "calls"), chat.RunCounters(spark), chat.RunCounters(spark)
    broken = df.withColumn("p", F.when(F.col("i") == 7, "broken").otherwise(F.col("p")))
    with pytest.raises(Exception, match="a bug"):
        chat.run_saved(broken, chat.FakeChat(failing), chain, "a string", path, ["i"], 4, 8, first)
    saved = spark.read.parquet(path).count()
    out = chat.run_saved(df, chat.FakeChat(failing), chain, "a string", path, ["i"], 4, 8, second)
    assert out.count() == 42 and out.where("a <> p").count() == 0
    assert second.as_dict()["completed"] == 41 - saved


def test_dialect(spark):
    df = spark.createDataFrame([("a", None, 1), ("|", "b", 2)], "p string, q string, generator int").drop("generator")
    got = dialect.rewritten(df, "p, q", "{text}", chat.FakeChat(lambda p, s: "|||" if p == "|" else f"{p}y"), sentinel_to_null=True).orderBy("q").collect()
    assert [(r["p"], r["q"], r["generator"]) for r in got] == [("ay", None, "fake-model"), (None, "by", "fake-model")]
    assert dialect.keys_consistent(spark.createDataFrame([("a", None)], "s string, p string"), ["p"], "s").count() == 1
    with pytest.raises(KeyError):
        dialect.rewritten(df, "zz", "{text}", chat.FakeChat(lambda p, s: p))


class Stub(http.server.BaseHTTPRequestHandler):
    script: list = []
    seen: list = []
    peers: set = set()
    protocol_version = "HTTP/1.1"

    def do_POST(self):
        self.peers.add(self.client_address)
        self.seen.append(json.loads(self.rfile.read(int(self.headers["Content-Length"]))))
        code, headers, body = self.script.pop(0)
        self.send_response(code)
        self.send_header("Content-Length", str(len(body.encode())))
        for k, v in headers.items():
            self.send_header(k, v)
        self.end_headers()
        self.wfile.write(body.encode())

    def log_message(self, *a):
        pass


@pytest.fixture
def stub():
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Stub)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    Stub.script, Stub.seen, Stub.peers = [], [], set()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def ok(content):
    return 200, {}, json.dumps({"choices": [{"message": {"content": content}}]})


def test_http_client(stub):
    waits = []
    client = chat.HttpChat(Endpoint(base_url=stub, model="m", max_retries=4, wait_seconds=1, retry_jitter_seconds=0), {2: False}, waits.append)
    Stub.script = [(503, {"Retry-After": "7"}, ""), (429, {"Retry-After": "soon"}, ""), ok(" "), ok([{"text": "a"}, {"x": 1}, "b"])]
    assert client.complete("p", 2) == "ab" and waits == [7, 2, 4]
    assert Stub.seen[0]["chat_template_kwargs"] == {"enable_thinking": False} and Stub.seen[0]["stream"] is False
    Stub.script = [(400, {}, "")]
    assert client.complete("p") == "" and "chat_template_kwargs" not in Stub.seen[-1]
    Stub.script = [(200, {}, "no json")] * 4
    assert client.complete("p") == ""
    assert chat.retry_delay(Endpoint(wait_seconds=5, retry_max_delay=30), 9) == 30
    assert len(Stub.peers) == 1  # one kept connection
    Stub.script = [ok("a"), ok("b")]
    hasty = chat.HttpChat(Endpoint(base_url=stub, model="m", keepalive_expiry=0))
    assert [hasty.complete("p"), hasty.complete("p")] == ["a", "b"] and len(Stub.peers) == 3


def test_settings(tmp_path):
    assert settings.thinking_switches({"step_1": "off", "answer": None, "5": True, "eval": False}) == {1: False, 2: None, 5: True}
    for bad in ({"max_chars": 0}, {"max_chars": 10, "overlap_chars": 10}, {"train_ratio": 0}):
        with pytest.raises(ValueError):
            CptSettings.of(bad)
    (tmp_path / "p.txt").write_text("x {text}")
    assert settings.load_prompts([{"a": str(tmp_path / "p.txt")}, {"b": str(tmp_path / "none")}], lenient=True) == {"a": "x {text}"}
    assert Endpoint.of({"infer_config": {"MODEL_NAME": "m", "max_tokens": 9}, "batch_size": 2}).max_in_flight == 2
    assert CptSettings.of({"cpt_enable_thinking": "no"}).enable_thinking is False


def test_stream(spark, tmp_path):
    conf = CptSettings(include_title=False, min_chars=1, max_chars=50, overlap_chars=0, output_path=str(tmp_path / "out"))
    (tmp_path / "in").mkdir()
    for n, texts in enumerate((["a", "b", "a"], ["b", "c"])):
        (tmp_path / "in" / f"{n}.json").write_text("\n".join([*(json.dumps({"id": t, "content": t}) for t in texts), "{broken"]))
        stream_chunks(spark, str(tmp_path / "in"), str(tmp_path / "check"), conf).awaitTermination()
        assert spark.read.json(str(tmp_path / "out" / "all.jsonl")).count() == (2, 3)[n]
    assert [r["value"] for r in spark.read.text(str(tmp_path / "out" / "rejected.jsonl")).collect()] == ["{broken"]


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "s.yaml").write_text(f"min_chars: 1\nmax_chars: 50\noverlap_chars: 5\noutput_path: {tmp_path}/out\n")
    assert cli.main(["cpt", "-p", str(tmp_path / "s.yaml"), "-s", source(tmp_path, ["a", "b"])]) == 0
    assert cli.main(["upload", "-d", str(tmp_path / "none"), "--dry-run"]) == 1
    assert cli.main(["upload", "-d", str(tmp_path / "none")]) == 1
    (tmp_path / "out" / "info.json").write_text('{"a": 1}')
    assert cli.main(["upload", "-d", str(tmp_path / "out"), "-t", "token"]) == 1  # nothing there that could publish
    pushed = []
    assert cli.main(["upload", "-d", str(tmp_path / "out"), "-t", "token", "-p", str(tmp_path / "stage")], publish=pushed.append) == 0
    assert pushed == [str(tmp_path / "stage")] and json.loads((tmp_path / "stage" / "info.json").read_text()) == {"a": 1}
    assert spark.read.json(str(tmp_path / "out" / "batch_status.jsonl")).first()["output_chunks"] == 2


def test_queries_have_rows(spark, small):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    for name in ("normalize_text", "candidates_per_entry", "batch_status", "qa_pipeline"):
        assert entry.queries()[name](spark, small).select(F.count("*")).first()[0] > 0

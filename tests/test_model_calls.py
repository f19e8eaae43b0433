"""Many requests at once, pauses after failures, and answers that a second run need not ask for."""

import http.server
import json
import threading
import time

import pytest

from corpusmill.config import Section
from corpusmill.sources import model

CHUNKS = "chunk_id string, document_title string, heading string, idx int, total int, body string"


@pytest.fixture
def server():
    """Answers after a moment, with the number of requests under way; bodies with "busy" fail the first two times, with "broken" always."""

    class Handler(http.server.BaseHTTPRequestHandler):
        calls, now, most, times, lock = [], 0, 0, {}, threading.Lock()

        def do_POST(self):
            own = type(self)
            text = json.loads(self.rfile.read(int(self.headers["Content-Length"])))["messages"][1]["content"]
            with own.lock:
                own.calls.append(text)
                own.now += 1
                own.most = max(own.most, own.now)
                own.times.setdefault(text, []).append(time.time())
            time.sleep(0.15)
            with own.lock:
                own.now -= 1
            failed = "broken" in text or "busy" in text and len(own.times[text]) < 3
            reply = json.dumps({"choices": [{"message": {"content": '{"chunk_type": "fact"}'}}]}).encode()
            self.send_response(503 if failed else 200)
            self.end_headers()
            self.wfile.write(b"" if failed else reply)

        def log_message(self, *args):
            pass

    running = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=running.serve_forever, daemon=True).start()
    yield Handler, Section("model", base_url=f"http://127.0.0.1:{running.server_port}/v1", retries=2)
    running.shutdown()
    running.server_close()


def chunks(spark, bodies):
    return spark.createDataFrame([(f"c{i}", "Title", "", i, len(bodies), b) for i, b in enumerate(bodies)], CHUNKS).coalesce(1)


def test_requests_of_a_task_run_at_once(spark, server):
    handler, cfg = server
    got = model.ask(chunks(spark, [f"body {i}" for i in range(12)]), cfg, parallel=4).collect()
    assert len(got) == 12 and all(r["answer"] for r in got) and handler.most == 4


def test_failures_wait_longer_each_time(spark, server):
    handler, cfg = server
    got = {r["chunk_id"]: r["answer"] for r in model.ask(chunks(spark, ["busy", "broken"]), cfg, pause=0.4).collect()}
    assert got["c0"] and got["c1"] is None
    (first, second, third) = handler.times[next(t for t in handler.times if "busy" in t)]
    assert second - first >= 0.2 + 0.15 and third - second >= 0.4 + 0.15


def test_a_second_run_asks_only_what_is_open(spark, server, tmp_path):
    handler, cfg = server
    path = str(tmp_path / "answers")
    run = lambda bodies: {r["chunk_id"]: r["answer"] is not None for r in model.ask_on(chunks(spark, bodies), cfg, path, runs=2, pause=0.01).collect()}
    assert run(["a", "b", "broken"]) == {"c0": True, "c1": True, "c2": False}
    handler.calls.clear()
    assert run(["a", "b", "broken"]) == {"c0": True, "c1": True, "c2": False} and all("broken" in c for c in handler.calls) and len(handler.calls) == 3
    handler.calls.clear()
    assert run(["a", "other", "mended"]) == {"c0": True, "c1": True, "c2": True} and len(handler.calls) == 2
    assert model.ask_on(chunks(spark, ["a"]).limit(0), cfg, path).collect() == []

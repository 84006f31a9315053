"""Run metrics: counters, gauges and histograms as a DataFrame and in Prometheus' text form; utilisation; stream progress."""

from __future__ import annotations

import bisect
import http.server
import threading
import time
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

#: Upper bounds of the duration buckets, in seconds. Fixed values.
BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0, 60.0)


class Metrics:
    """Counters, gauges and duration histograms by name and labels; safe to use from several threads."""

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self.counters: dict[tuple, float] = defaultdict(float)
        self.gauges: dict[tuple, float] = {}
        self.histograms: dict[tuple, list[float]] = {}

    @staticmethod
    def _key(name: str, labels: dict[str, str]) -> tuple:
        return (name, *sorted(labels.items()))

    def add(self, name: str, value: float = 1, **labels: str) -> None:
        with self._lock:
            self.counters[self._key(name, labels)] += value

    def set(self, name: str, value: float, **labels: str) -> None:
        with self._lock:
            self.gauges[self._key(name, labels)] = value

    def observe(self, name: str, seconds: float, **labels: str) -> None:
        with self._lock:
            cells = self.histograms.setdefault(self._key(name, labels), [0.0] * (len(BUCKETS) + 2))
            cells[bisect.bisect_left(BUCKETS, seconds)] += 1
            cells[-1] += seconds

    def dataframe(self, spark: SparkSession) -> DataFrame:
        rows = [(k[0], "counter", dict(k[1:]), float(v)) for k, v in self.counters.items()]
        rows += [(k[0], "gauge", dict(k[1:]), float(v)) for k, v in self.gauges.items()]
        rows += [(f"{k[0]}_count", "histogram", dict(k[1:]), float(sum(v[:-1]))) for k, v in self.histograms.items()]
        return spark.createDataFrame(rows, "name string, kind string, labels map<string,string>, value double")

    def exposition(self) -> str:
        """The text that a /metrics endpoint serves."""
        text = lambda labels: "{" + ",".join(f'{a}="{b}"' for a, b in labels) + "}" if labels else ""
        with self._lock:
            out = [f"{k[0]}_total{text(k[1:])} {v:g}" for k, v in sorted(self.counters.items())]
            out += [f"{k[0]}{text(k[1:])} {v:g}" for k, v in sorted(self.gauges.items())]
            for k, cells in sorted(self.histograms.items()):
                sums = 0.0
                for bound, n in zip([*map(str, BUCKETS), "+Inf"], cells[:-1], strict=True):
                    sums += n
                    out.append(f"{k[0]}_bucket{text((*k[1:], ('le', bound)))} {sums:g}")
                out += [f"{k[0]}_sum{text(k[1:])} {cells[-1]:g}", f"{k[0]}_count{text(k[1:])} {sums:g}"]
        return "\n".join(out) + "\n"

    def serve(self, address: str) -> http.server.ThreadingHTTPServer:
        """/metrics and /health on host:port, from a thread of its own; shutdown() ends it."""
        metrics = self

        class Handler(http.server.BaseHTTPRequestHandler):
            def do_GET(self) -> None:  # noqa: N802
                body = {"/metrics": metrics.exposition(), "/health": "ok\n"}.get(self.path)
                self.send_response(200 if body is not None else 404)
                self.send_header("Content-Type", "text/plain; version=0.0.4")
                self.end_headers()
                self.wfile.write((body or "not found\n").encode())

            def log_message(self, *args) -> None:
                pass

        host, _, port = address.rpartition(":")
        server = http.server.ThreadingHTTPServer((host, int(port)), Handler)
        threading.Thread(target=server.serve_forever, daemon=True).start()
        return server


class Utilization:
    """Share of time at work, as a moving average whose newest interval weighs 1 - ALPHA."""

    ALPHA = 0.9

    def __init__(self, clock=time.monotonic) -> None:
        self.clock, self.value, self.busy = clock, 0.0, 0.0
        self.since = self.began = clock()
        self.working = False

    def _settle(self, now: float) -> None:
        if self.working:
            self.busy += now - self.since
        self.since = now

    def start_work(self) -> None:
        self._settle(self.clock())
        self.working = True

    def stop_work(self) -> None:
        self._settle(self.clock())
        self.working = False

    def report(self) -> float:
        now = self.clock()
        self._settle(now)
        if now > self.began:
            self.value = self.ALPHA * self.value + (1 - self.ALPHA) * min(1.0, self.busy / (now - self.began))
        self.busy, self.began = 0.0, now
        return self.value


class ProgressListener(StreamingQueryListener):
    """Puts a streaming query's progress into metrics."""

    def __init__(self, metrics: Metrics):
        self.metrics = metrics

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.metrics.add("queries_started")

    def onQueryProgress(self, event) -> None:  # noqa: N802
        self.metrics.add("records_processed", event.progress.numInputRows, target=str(event.progress.name))
        self.metrics.add("batches_processed", target=str(event.progress.name))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.metrics.add("queries_ended")

"""Alert texts and their delivery: a bounded queue, retries, and addresses that never show in errors."""

from __future__ import annotations

import json
import queue
import random
import threading
import time
import urllib.error
import urllib.request

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timberline.functions.text import escape_chat


def duration(seconds: float) -> str:
    """A length of time in whole seconds, as texts of alerts give it: 20s, 1m30s, 2h0m5s."""
    whole = round(seconds)
    hours, minutes, rest = whole // 3600, whole // 60 % 60, whole % 60
    return f"{hours}h{minutes}m{rest}s" if hours else f"{minutes}m{rest}s" if minutes else f"{rest}s"


#: Fixed texts of an alert; their wording has to match.
SPIKE = ":rotating_light: *Error spike in `%s`*\n%d errors in the last %s (usually about %d)."
RECENT, SAMPLE_LINE = "\nMost recent:", "\n• `%s`"
NORMAL = ":white_check_mark: *Errors back to normal in `%s`* (%d in the last %s)"


def texts(window: float) -> Column:
    """The message of every alert (service, kind, errors, usual, samples) over a window of so many seconds.

    What was usual is given as a whole number, halves as the even one.
    """
    service, length = escape_chat(F.col("service")), F.lit(duration(window))
    lines = F.transform("samples", lambda x: F.format_string(SAMPLE_LINE, F.replace(escape_chat(x), F.lit("`"), F.lit("'"))))
    recent = F.when(F.size("samples") > 0, F.concat(F.lit(RECENT), F.array_join(lines, ""))).otherwise(F.lit(""))
    spike = F.format_string(SPIKE, service, F.col("errors"), length, F.bround("usual", 0).cast("bigint"))
    return F.when(F.col("kind") == "resolved", F.format_string(NORMAL, service, F.col("errors"), length)).otherwise(F.concat(spike, recent))


def rendered(alerts: DataFrame, window: float) -> DataFrame:
    """Adds text, the message of every alert."""
    return alerts.withColumn("text", texts(window))


def render(alert: dict, window: float = 60.0) -> str:
    """``texts`` for one alert on its way out."""
    esc = lambda x: str(x).replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    service, length = esc(alert["service"]), duration(window)
    if alert["kind"] == "resolved":
        return NORMAL % (service, alert["errors"], length)
    samples = [SAMPLE_LINE % esc(x).replace("`", "'") for x in alert.get("samples") or ()]
    return SPIKE % (service, alert["errors"], length, round(alert["usual"])) + (RECENT + "".join(samples) if samples else "")


def backoff(attempt: int, base: float = 0.1, most: float = 30.0, rng=random.random) -> float:
    """A wait between nothing and the ceiling of the attempt."""
    return rng() * min(base * 2 ** min(attempt, 60), most)


class Webhook:
    def __init__(self, url: str, attempts: int = 5, send=None, sleep=time.sleep, window: float = 60.0):
        self.window = window
        self.url, self.attempts, self.send, self.sleep = url, attempts, send or self._post, sleep

    def _post(self, body: bytes) -> tuple[int, str]:
        request = urllib.request.Request(self.url, body, {"Content-Type": "application/json"})
        try:
            with urllib.request.urlopen(request, timeout=10) as r:
                return r.status, ""
        except urllib.error.HTTPError as e:
            return e.code, e.headers.get("Retry-After") or ""

    def notify(self, alert: dict) -> None:
        body = json.dumps({"text": render(alert, self.window)}).encode()
        for attempt in range(self.attempts):
            try:
                status, after = self.send(body)
            except OSError:
                status, after = 0, ""
            if 200 <= status < 300:
                return
            if status and status != 429 and status < 500:
                raise RuntimeError(f"the webhook answered {status}")
            if attempt + 1 < self.attempts:
                wait = float(after) if after.isdigit() else backoff(attempt)
                self.sleep(min(max(wait, 1.0), 30.0) if status == 429 and after.isdigit() else wait)
        raise RuntimeError("the webhook could not be reached")


class AlertQueue:
    """Delivers in the background; what finds the queue full is dropped and counted."""

    def __init__(self, notify, size: int = 64):
        self.notify, self.queue, self.dropped, self.failed = notify, queue.Queue(size), 0, 0
        self.thread = threading.Thread(target=self._run, daemon=True)
        self.thread.start()

    def put(self, alert: dict) -> bool:
        try:
            self.queue.put_nowait(alert)
            return True
        except queue.Full:
            self.dropped += 1
            return False

    def _run(self) -> None:
        while (alert := self.queue.get()) is not None:
            try:
                self.notify(alert)
            except Exception:  # noqa: BLE001  one failed delivery must not stop the others
                self.failed += 1

    def close(self) -> None:
        """Deliver what is queued, then stop."""
        self.queue.put(None)
        self.thread.join()

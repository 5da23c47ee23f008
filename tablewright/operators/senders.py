"""Senders for ``delivery.deliver``.

``json_post_sender`` posts each request's JSON document to an HTTP endpoint
with the standard library and maps the response to the sender protocol:
HTTP status and reason, ``Retry-After`` seconds, and 999 for a transport
error (connection refused, reset, timeout). A thread of a task keeps one connection
per host open for all its requests. ``opener`` and ``connect`` are injectable,
so all this is tested without any network.
"""

from __future__ import annotations

import http.client
import threading
import urllib.error
import urllib.request
from urllib.parse import urlsplit

import pandas as pd

from tablewright.operators.delivery import TRANSPORT_ERROR


def _retry_after(headers) -> int:
    try:
        return max(0, int((headers or {}).get("Retry-After", "0")))
    except (TypeError, ValueError):
        return 0


def _connect(scheme: str, host: str, timeout: float):
    kind = http.client.HTTPSConnection if scheme == "https" else http.client.HTTPConnection
    return kind(host, timeout=timeout)


class KeptConnection:
    """An opener that keeps one connection per thread and host. A connection that
    the endpoint closed between two requests is opened again, once; connections
    do not travel with a task."""

    def __init__(self, connect=_connect):
        self.connect, self._own = connect, threading.local()

    def __getstate__(self):
        return {"connect": self.connect}

    def __setstate__(self, state):
        self.__init__(state["connect"])

    def _send(self, conn, request, target: str):
        conn.request(request.get_method(), target, body=request.data, headers=dict(request.header_items()))
        response = conn.getresponse()
        response.read()     # the connection is free for the next request
        return response

    def __call__(self, request, timeout: float):
        url = urlsplit(request.full_url)
        target = (url.path or "/") + (f"?{url.query}" if url.query else "")
        open_ = self._own.__dict__.setdefault("open", {})
        at = (url.scheme, url.netloc)
        kept = open_.pop(at, None)
        if kept is not None:
            try:
                response = self._send(kept, request, target)
                open_[at] = kept
                return response
            except (http.client.RemoteDisconnected, ConnectionResetError, BrokenPipeError):
                kept.close()
        conn = self.connect(url.scheme, url.netloc, timeout)
        try:
            response = self._send(conn, request, target)
        except BaseException:
            conn.close()
            raise
        open_[at] = conn
        return response


def json_post_sender(url: str, headers: dict | None = None, timeout: float = 10.0, opener=None):
    """A sender posting ``data`` (JSON text) with ``headers``; one call per
    request row. Credentials belong in ``headers`` supplied by the caller."""
    hdrs = {"Content-Type": "application/json", **(headers or {})}
    open_url = opener or KeptConnection()

    def send(requests: pd.DataFrame, attempt: int) -> pd.DataFrame:
        status, reason, retry = [], [], []
        for body in requests["data"]:
            req = urllib.request.Request(url, data=str(body).encode("utf-8"), headers=hdrs, method="POST")
            try:
                with open_url(req, timeout=timeout) as resp:
                    status.append(int(resp.status))
                    reason.append(str(getattr(resp, "reason", "")))
                    retry.append(_retry_after(resp.headers))
            except urllib.error.HTTPError as e:
                status.append(int(e.code))
                reason.append(str(e.reason))
                retry.append(_retry_after(e.headers))
            except (urllib.error.URLError, http.client.HTTPException, OSError) as e:
                status.append(TRANSPORT_ERROR)
                reason.append(f"Protocol error: {type(e).__name__}")
                retry.append(0)
        return pd.DataFrame({"status": status, "reason": reason, "retry_after": retry})

    return send

"""Fetching payloads over HTTP: bounded retries, a respected and capped Retry-After, and errors that never show secrets."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from urllib.parse import urlencode, urlsplit, urlunsplit

TIMEOUT_S = 30.0


class TransportError(RuntimeError):
    """A fetch that failed for good: names the endpoint without its query."""


# How often a request is sent at most, and the seconds waited in between.
ATTEMPTS, FIRST_WAIT_S, LONGEST_WAIT_S = 3, 0.5, 8.0


def waits(attempts: int = ATTEMPTS, first: float = FIRST_WAIT_S, longest: float = LONGEST_WAIT_S) -> Iterator[float]:
    """The waits between so many attempts: each is twice the one before, up to the longest."""
    if attempts < 1 or min(first, longest) < 0:
        raise ValueError("there must be an attempt, and no wait can be negative")
    return (min(first * 2**k, longest) for k in range(attempts - 1))


def endpoint(url: str) -> str:
    """Scheme, host and path alone."""
    parts = urlsplit(url)
    return urlunsplit((parts.scheme, parts.hostname or "", parts.path, "", ""))


@dataclass(frozen=True)
class Response:
    status: int
    body: bytes
    headers: Mapping[str, str]


def open_url(url: str) -> Response:
    request = urllib.request.Request(url, headers={"Accept": "*/*", "User-Agent": "tideline/1"})
    try:
        with urllib.request.urlopen(request, timeout=TIMEOUT_S) as got:
            return Response(got.status, got.read(), dict(got.headers))
    except urllib.error.HTTPError as error:
        return Response(error.code, error.read(), dict(error.headers or {}))


def _asked_to_wait(response: Response) -> float | None:
    told = {k.lower(): v for k, v in response.headers.items()}.get("retry-after", "")
    return float(told) if told.replace(".", "", 1).isdigit() else None


def fetch(url: str, query: Mapping[str, str] | None = None, *, pauses: Callable[[], Iterator[float]] = waits, longest: float = LONGEST_WAIT_S, send: Callable[[str], Response] = open_url, sleep: Callable[[float], None] = time.sleep, accepted: Callable[[Response], bool] = lambda r: 200 <= r.status <= 299) -> Response:
    """A response that is accepted. What may pass (too many requests, a server's error, no connection) is tried again after each pause, or after what the server asks for, up to the longest."""
    whole, left = f"{url}?{urlencode(query)}" if query else url, pauses()
    while True:
        asked = None
        try:
            got = send(whole)
        except OSError as error:
            what = type(error).__name__
        else:
            if accepted(got):
                return got
            what, asked = f"status {got.status}", _asked_to_wait(got)
            if got.status != 429 and got.status // 100 != 5:
                break
        if (pause := next(left, None)) is None:
            break
        sleep(pause if asked is None else min(asked, longest))
    raise TransportError(f"{endpoint(url)}: {what}") from None

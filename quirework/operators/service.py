"""A page model behind an HTTP service that takes chat requests with images; needs the standard library only."""

from __future__ import annotations

import base64
import json
import urllib.error
import urllib.request
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import pandas as pd

from quirework.config import Settings


def failure_class(error: Exception) -> str:
    """Class of a failed request, as the retry rules know it; timeouts go before connections."""
    if isinstance(error, urllib.error.HTTPError):
        return {401: "auth", 403: "auth", 429: "rate_limit"}.get(error.code, f"http_{error.code}")
    reason = getattr(error, "reason", error)
    if isinstance(reason, TimeoutError) or isinstance(error, TimeoutError):
        return "timeout"
    return "connection" if isinstance(error, (urllib.error.URLError, ConnectionError)) else "unknown"


def image_type(image: bytes) -> str:
    """MIME type of an image by its first bytes."""
    if image[:8] == b"\x89PNG\r\n\x1a\n":
        return "image/png"
    if image[:4] == b"RIFF" and image[8:12] == b"WEBP":
        return "image/webp"
    return "image/gif" if image[:4] == b"GIF8" else "image/bmp" if image[:2] == b"BM" else "image/jpeg"


class ServiceModel:
    """Sends every request of a batch, several at a time, and gives the answers in the order of the requests.

    Requests need ``image`` (bytes) and may have a ``prompt``; others get the default one.
    """

    def __init__(self, base: str, key: str, name: str, prompt: str, max_tokens: int, timeout: float, concurrency: int = 64, headers: dict[str, str] | None = None) -> None:
        self.url = f"{base.rstrip('/')}/chat/completions"
        self.headers = {"Content-Type": "application/json", "Authorization": f"Bearer {key}", **(headers or {})}
        self.name, self.prompt, self.max_tokens, self.timeout, self.concurrency = name, prompt, max_tokens, timeout, concurrency

    def body(self, image: bytes, prompt: str, temperature: float, top_p: float) -> dict:
        """A request: the image, then the prompt."""
        url = f"data:{image_type(image)};base64,{base64.b64encode(image).decode('ascii')}"
        content = [{"type": "image_url", "image_url": {"url": url}}, {"type": "text", "text": prompt}]
        return {"model": self.name, "messages": [{"role": "user", "content": content}], "max_tokens": self.max_tokens, "temperature": temperature, "top_p": top_p}

    def ask(self, image: bytes, prompt: str, temperature: float, top_p: float) -> tuple[str, int, bool, str | None]:
        """raw, token_count, error and error_kind of one request; whatever goes wrong is an error answer."""
        try:
            data = json.dumps(self.body(image, prompt, temperature, top_p)).encode("utf-8")
            with urllib.request.urlopen(urllib.request.Request(self.url, data, self.headers), timeout=self.timeout) as answer:  # noqa: S310 - the address is a setting
                found = json.load(answer)
            return found["choices"][0]["message"]["content"] or "", int(found["usage"]["completion_tokens"]), False, None
        except Exception as error:  # noqa: BLE001 - a failed request is a failed row
            return "", 0, True, failure_class(error)

    def generate(self, requests: pd.DataFrame, temperature: float, top_p: float) -> pd.DataFrame:
        own = requests["prompt"].tolist() if "prompt" in requests else [None] * len(requests)
        work = [(bytes(image), prompt or self.prompt, temperature, top_p) for image, prompt in zip(requests["image"], own)]
        with ThreadPoolExecutor(max(1, min(self.concurrency, len(work)))) as pool:
            rows = list(pool.map(lambda w: self.ask(*w), work))
        return pd.DataFrame(rows, columns=["raw", "token_count", "error", "error_kind"])


def service_factory(settings: Settings, prompt: str, max_tokens: int | None = None, headers: dict[str, str] | None = None) -> Callable[[], ServiceModel]:
    """Factory of the service that the settings name, for :func:`quirework.operators.model.generate`."""
    limit = settings.max_output_tokens if max_tokens is None else max_tokens
    return lambda: ServiceModel(settings.api_base, settings.api_key, settings.model_name, prompt, limit, settings.client_timeout, headers=headers)

"""A client of chat completions over HTTP, for ``generation.completions``."""

from __future__ import annotations

import http.client
import json
import os
import urllib.error
import urllib.request
from dataclasses import dataclass

from talkweave.config import Generation


@dataclass(frozen=True)
class ChatClient:
    """Called with a prompt, gives the response's text. A full or failing server (429, 5xx) and a broken or slow connection raise ConnectionError or
    TimeoutError, which callers may try again; any other refusal raises RuntimeError, which they shouldn't."""

    settings: Generation
    key: str

    def __call__(self, prompt: str) -> str:
        g = self.settings
        sampling = {k: v for k in ("model", "temperature", "top_p", "max_tokens") if (v := getattr(g, k)) is not None}
        body = json.dumps(sampling | {"messages": [{"role": "user", "content": prompt}]}).encode()
        request = urllib.request.Request(f"{g.base_url.rstrip('/')}/chat/completions", body, {"Authorization": f"Bearer {self.key}", "Content-Type": "application/json"})
        try:
            with urllib.request.urlopen(request, timeout=g.api_timeout_sec) as response:
                return json.load(response)["choices"][0]["message"]["content"]
        except urllib.error.HTTPError as e:
            if e.code == 429 or e.code >= 500:
                raise ConnectionError(f"status {e.code}") from None
            raise RuntimeError(f"the API refused the request: status {e.code}") from None
        except urllib.error.URLError as e:
            raise ConnectionError(str(e.reason)) from None
        except http.client.HTTPException as e:
            raise ConnectionError(type(e).__name__) from None


def from_settings(g: Generation) -> ChatClient | None:
    """The client that settings and environment describe; None where the address, the model or the key is missing."""
    key = os.environ.get(g.api_key_env)
    if not (g.base_url and g.model and key):
        return None
    return ChatClient(g, key)

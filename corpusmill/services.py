"""Clients of the services that models stand behind. Standard library only; each retries and gives null for an input that keeps failing."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
import uuid


def post_json(url: str, data: dict, timeout: float, headers: dict | None = None, tries: int = 3, wait: float = 1.0):
    """The parsed answer, or null after ``tries`` failures."""
    body = json.dumps(data).encode()
    for attempt in range(tries):
        try:
            request = urllib.request.Request(url, body, {"Content-Type": "application/json", **(headers or {})})
            with urllib.request.urlopen(request, timeout=timeout) as answer:
                return json.load(answer)
        except (urllib.error.URLError, TimeoutError, ValueError):
            if attempt + 1 < tries:
                time.sleep(wait * 2**attempt)
    return None


def get_json(base: str, timeout: float = 50):
    """A fetch function for bibliographic look-ups."""

    def fetch(path: str):
        try:
            with urllib.request.urlopen(f"{base.rstrip('/')}/{path}", timeout=timeout) as answer:
                return json.load(answer)
        except (urllib.error.URLError, TimeoutError, ValueError):
            return None

    return fetch


def remote_embedder(url: str, model: str, api_key: str = "EMPTY", timeout: float = 300):
    """Texts in batches to ``/v1/embeddings``; all of a batch are null if it fails."""

    def embed(texts: list[str]) -> list[list[float] | None]:
        answer = post_json(f"{url.rstrip('/')}/v1/embeddings", {"model": model, "input": texts, "encoding_format": "float"}, timeout, {"Authorization": f"Bearer {api_key}"})
        rows = sorted((answer or {}).get("data", []), key=lambda r: r["index"])
        return [r["embedding"] for r in rows] if len(rows) == len(texts) else [None] * len(texts)

    return embed


def pdf_service(url: str, timeout: float = 300):
    """PDF bytes to ``/predict/`` as a form's file; its text, or null."""

    def read(data: bytes) -> str | None:
        mark = uuid.uuid4().hex
        body = f'--{mark}\r\nContent-Disposition: form-data; name="file"; filename="document.pdf"\r\nContent-Type: application/pdf\r\n\r\n'.encode() + data + f"\r\n--{mark}--\r\n".encode()
        try:
            request = urllib.request.Request(f"{url.rstrip('/')}/predict/", body, {"Content-Type": f"multipart/form-data; boundary={mark}"})
            with urllib.request.urlopen(request, timeout=timeout) as answer:
                text = answer.read().decode("utf-8", "replace")
        except (urllib.error.URLError, TimeoutError):
            return None
        try:
            return json.loads(text)
        except ValueError:
            return text

    return read


def masking_service(url: str, entities=("PERSON", "EMAIL_ADDRESS"), threshold: float = 0.35, timeout: float = 120):
    """A text to ``/predict``; the masked text, or null if the service fails: a text that isn't masked never comes back."""

    def mask(text: str) -> str | None:
        answer = post_json(f"{url.rstrip('/')}/predict", {"text": text, "entities": list(entities), "score_threshold": threshold, "return_analysis": False}, timeout)
        return answer["anonymized_text"] if answer and answer.get("success", True) and "anonymized_text" in answer else None

    return mask


def correction_service(url: str, api_key: str, model: str, timeout: float = 30):
    """LaTeX correction by a chat model: (formula, problem, text) to the corrected formula, or null."""

    def correct(formula: str, problem: str, text: str) -> str | None:
        at = text.find(formula)
        context = text[max(0, at - 200) : at + len(formula) + 200]
        prompt = f"This LaTeX formula has an error ({problem}). Return only the corrected formula, without explanation.\n\nFormula:\n{formula}\n\nContext:\n{context}"
        answer = post_json(url, {"model": model, "messages": [{"role": "user", "content": prompt}], "temperature": 0.1, "max_tokens": 1000}, timeout, {"Authorization": f"Bearer {api_key}"})
        choices = (answer or {}).get("choices") or []
        reply = choices[0]["message"]["content"].strip() if choices else ""
        if reply.startswith("```"):
            reply = reply.strip("`").partition("\n")[2].strip()
        return reply or None

    return correct

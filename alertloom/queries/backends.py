"""A backend that answers from the prompt's digest, so SQL can check the answers."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence


def backend_factory(kind: str | None = None, raises: bool = False):
    """Text, number or table answers; some are malformed so that fallbacks show.

    Without a kind the prompt says which of the three is wanted. With ``raises`` a call
    with a prompt whose digest starts with 9 fails as a whole.

    The class is local, so it travels to the tasks with the factory and the
    package need not be installed there.
    """

    class DigestBackend:
        def complete(self, prompts: Sequence[str], **options) -> list[str]:
            digests = [hashlib.md5(p.encode()).hexdigest() for p in prompts]
            if raises and any(d[0] == "9" for d in digests):
                raise ConnectionError("no answer to this batch")
            return [
                self.answer(d, kind or self.wanted(p))
                for d, p in zip(digests, prompts, strict=True)
            ]

        def wanted(self, prompt: str) -> str:
            if "single numeric value" in prompt:
                return "number"
            return "table" if "action plan" in prompt else "text"

        def answer(self, digest: str, kind: str) -> str:
            if digest[0] == "0":
                return "no answer"
            candidate = {"content": {"parts": [{"text": self.body(digest, kind)}]}}
            if digest[0] in "12345":
                candidate["finish_reason"] = "MAX_TOKENS"
            return json.dumps({"candidates": [candidate]})

        def body(self, digest: str, kind: str) -> str:
            if kind == "text":
                return f"Answer {digest}"
            number = int(digest[1:5], 16) % 1000
            if kind == "number":
                return "unclear" if digest[0] == "f" else str(number)
            if digest[0] == "f":
                return "[]"
            first = {
                "department": f"unit {digest[5]}",
                "priority": "HIGH",
                "key_action": f"act on {digest}",
                "estimated_hours": number,
            }
            second = {
                "department": "Pharmacy",
                "priority": "URGENT",
                "key_action": "review",
                "estimated_hours": 5,
            }
            return json.dumps([first, second])

    return DigestBackend

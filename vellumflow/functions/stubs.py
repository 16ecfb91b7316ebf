"""Small stand-ins for models, for tests and the registered queries. Each has a plain SQL equivalent."""

from __future__ import annotations

import json

import numpy as np

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def letter_embedder():
    """Counts of the letters a to z in the whole text."""

    def embed(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), len(LETTERS)), np.float32)
        for row, text in enumerate(texts):
            lowered = text.lower()
            out[row] = [lowered.count(letter) for letter in LETTERS]
        return out

    return embed


def size_describer():
    """Describes a text by its size."""
    return lambda texts: [f"{len(t)} characters in {t.count(chr(10)) + 1} lines" for t in texts]


def prompt_echo():
    """Answers a prompt given as JSON by its number of messages and its last one."""

    def answer(prompts: list[str]) -> list[str]:
        out = []
        for prompt in prompts:
            messages = json.loads(prompt)
            out.append(f"So, yeah. {len(messages)} messages, the last has {len(messages[-1]['content'])} characters")
        return out

    return answer


def url_fetcher():
    """Serves every URL but those with a fragment."""
    return lambda url: (404, None) if "#" in url else (200, f"body of {url}".encode())

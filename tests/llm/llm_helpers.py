"""What the tests of the llm operators share."""

import re

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """A table of documents from ``(doc_id, text)`` or ``(doc_id, text, lang, source)`` rows."""

    def make(rows, schema=DOCS):
        full = [(*r, "en", "s") if len(r) == 2 else r for r in rows]
        return spark.createDataFrame([(*r, len(r[1] or "")) for r in full], schema)

    return make


def sets(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def brute(rows):
    s = {i: sets(t) for i, t in rows}
    label = {i: i for i in s}
    changed = True
    while changed:
        changed = False
        for a in s:
            for b in s:
                i = len(s[a] & s[b])
                if s[a] and 100 * i >= 75 * (len(s[a]) + len(s[b]) - i) and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return {i: (len(s[i]), label[i]) for i in s}

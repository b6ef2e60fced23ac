"""Secret scan: all rules in one pass of one automaton over the bytes of many documents."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from starwash.llm.automaton import Reader, Rule, compile_rules
from starwash.llm.common import text_bytes

#: The base rules, in the order in which kinds are listed.
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=\-]+""",
        least=12, of_tail=True, any_case=True,
    ),
    Rule("access", "AKIA[A-Z0-9]+", least=18),
    Rule("hex", "[0-9a-f]{16,}"),
)

#: Shapes of well-known credentials; each starts with a text that prose does not hold.
MORE = (
    Rule("private_key", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9\-]+", least=24),
    Rule("stripe", "[rs]k_live_[A-Za-z0-9]+", least=24),
    Rule("google", r"AIza[A-Za-z0-9_\-]+", least=39),
)

SEPARATOR = b"\n"  # no rule reads on after it
BATCH_BYTES = 1 << 22
COLUMNS = [*(f"n_{r.kind}" for r in BASE), "base_sha256", "spans", "n_spans"]
SCHEMA = ", ".join(f"{c} {'string' if c in ('base_sha256', 'spans') else 'long'}" for c in COLUMNS)


def _listed(spans: list[tuple[int, int, int]], rules: tuple[Rule, ...]) -> str:
    return ",".join(f"{rules[r].kind}:{start}:{end}" for start, r, end in sorted((s, r, e) for r, s, e in spans))


def scan_texts(texts: list[bytes], reader: Reader) -> list[tuple]:
    """One row of COLUMNS per text; positions in code points."""
    rules = reader.automaton.rules
    starts = np.cumsum([0, *(len(t) + len(SEPARATOR) for t in texts)])
    spans: dict[int, list[tuple[int, int, int]]] = {}
    for r, start, end in reader.spans(SEPARATOR.join(texts) + SEPARATOR, starts):
        doc = int(np.searchsorted(starts, start, "right")) - 1
        spans.setdefault(doc, []).append((r, start - int(starts[doc]), end - int(starts[doc])))
    empty = (0,) * len(BASE) + (hashlib.sha256(b"").hexdigest(), "", 0)
    rows = []
    for doc, text in enumerate(texts):
        if doc not in spans:
            rows.append(empty)
            continue
        data = np.frombuffer(text, dtype=np.uint8)
        before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
        own = [(r, int(before[s]), int(before[e])) for r, s, e in spans[doc]]
        base = [x for x in own if x[0] < len(BASE)]
        digest = hashlib.sha256(_listed(base, rules).encode()).hexdigest()
        counts = (sum(r == k for r, _, _ in base) for k in range(len(BASE)))
        rows.append((*counts, digest, _listed(own, rules), len(own)))
    return rows


def find_secrets(docs: DataFrame, more: tuple[Rule, ...] = MORE) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_spans) for every row of ``docs``.

    ``spans`` lists kind:start:end of the base rules and of ``more`` by start, then by the order of the
    kinds. A null text counts as empty and has no spans; repeated rows give equal rows; other columns are
    left out. Documents are scanned in runs of about BATCH_BYTES, a longer one by itself, always whole.
    """
    automaton = compile_rules(BASE + more)

    @F.pandas_udf(SCHEMA)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        reader = Reader(automaton)
        for texts in batches:
            rows, run, size = [], [], 0
            for text in texts:
                if run and size + len(text) > BATCH_BYTES:
                    rows += scan_texts(run, reader)
                    run, size = [], 0
                run.append(text)
                size += len(text)
            rows += scan_texts(run, reader) if run else []
            yield pd.DataFrame(rows, columns=COLUMNS)

    return docs.select("doc_id", scan(text_bytes()).alias("s")).select("doc_id", "s.*")

"""Personal data inside JSON payloads (S5, P5): every leaf is masked and the document stays valid.

Patterns on the JSON text would see escapes and punctuation of the text as content, and a masked number
would not parse.  So each document is parsed, its leaves are walked, and it is written again.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT

MASKED = "masked string, found array<struct<path: string, pii_type: string>>, parsed boolean"


def mask_document(text: str | None, patterns: list[tuple[str, re.Pattern]]) -> tuple[str | None, list[dict], bool]:
    """The document with its matches replaced, where they were found, and whether it is JSON.

    Strings are masked in place; a number that matches as a whole becomes a string; keys stay, as do true, false and null.
    Text that is not JSON is masked as one string."""
    found: list[dict] = []

    def masked(value: str, path: str) -> str:
        for kind, pattern in patterns:
            value, n = pattern.subn(f"[REDACTED:{kind}]", value)
            if n:
                found.append({"path": path, "pii_type": kind})
        return value

    def walk(value, path: str):
        if isinstance(value, str):
            return masked(value, path)
        if isinstance(value, dict):
            return {k: walk(v, f"{path}.{k}") for k, v in value.items()}
        if isinstance(value, list):
            return [walk(v, f"{path}[{i}]") for i, v in enumerate(value)]
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            n = len(found)
            as_text = masked(str(value), path)
            return as_text if len(found) > n else value
        return value
    if text is None:
        return None, [], False
    try:
        document = json.loads(text)
    except (ValueError, RecursionError):
        return masked(text, "$"), found, False
    return json.dumps(walk(document, "$"), ensure_ascii=False, separators=(",", ":")), found, True


def mask_payloads(df: DataFrame, payload_col: str = "raw_payload", cfg: dict | None = None) -> DataFrame:
    """P5 on a JSON column: the column masked, ``pii_found`` (path and type in order) and ``payload_parsed``.

    A null payload stays null.  One Arrow pass over the payloads; other columns do not go through Python."""
    rules = (cfg or DEFAULT["policies"])["pii_patterns"]
    sources = [(kind, "(?i)" + pattern) for kind, pattern, _, _ in rules]

    @F.pandas_udf(MASKED)
    def run(texts: pd.Series) -> pd.DataFrame:
        patterns = [(kind, re.compile(p, re.ASCII)) for kind, p in sources]
        return pd.DataFrame([mask_document(t, patterns) for t in texts], columns=["masked", "found", "parsed"])
    r = df.withColumn("_m", run(F.col(payload_col)))
    return r.select(*[F.col("_m.masked").alias(c) if c == payload_col else F.col(c) for c in df.columns],
                    F.col("_m.found").alias("pii_found"), F.col("_m.parsed").alias("payload_parsed"))

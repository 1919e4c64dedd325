"""URL filters: host and path rules, and a weighted vocabulary found by one Aho-Corasick pass."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from cohorta.llm.common import travels

travels(__name__)

# Terms that reject a URL alone, and terms of which several different ones do.
STRICT = ["adult", "casino", "escort", "gambling", "malware", "phishing", "porn", "sex", "viagra", "warez", "xxx"]
SOFT = ["ads", "bet", "bets", "bonus", "cheap", "click", "farm", "free", "hack", "loan", "loans", "pills", "poker",
        "prize", "spam", "track", "win", "x"]

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_WORD = set("abcdefghijklmnopqrstuvwxyz0123456789")
_END = re.compile(r"[/?#]")


@dataclass
class UrlRules:
    """``rules``: (verdict, rule) pairs, a rule being a host and the start of a path, as ``net/``."""

    rules: list[tuple[str, str]] = field(default_factory=list)

    def __post_init__(self):
        self.by_host: dict[str, list[tuple[str, str, str]]] = defaultdict(list)
        for verdict, rule in self.rules:
            host, slash, path = rule.partition("/")
            self.by_host[host].append((slash + path, rule, verdict))
        for fitting in self.by_host.values():
            fitting.sort(key=lambda r: (-len(r[0]), r[1]))

    def of(self, host: str, path: str) -> tuple[str, str] | None:
        """The longest rule that fits, and its verdict."""
        best: tuple[str, str] | None = None
        at = 0
        while True:
            for start, rule, verdict in self.by_host.get(host[at:], ()):
                if path.startswith(start):
                    if best is None or len(rule) > len(best[0]):
                        best = (rule, verdict)
                    break
            dot = host.find(".", at)
            if dot < 0:
                return best
            at = dot + 1


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    if not url or "://" not in url:
        return "", ""
    rest = url.partition("://")[2]
    cut = _END.search(rest)
    host = rest[:cut.start()] if cut else rest
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    return host.translate(_LOWER), path


@dataclass
class Vocabulary:
    strict: list[str] = field(default_factory=lambda: list(STRICT))
    soft: list[str] = field(default_factory=lambda: list(SOFT))
    soft_limit: int = 2  # different soft terms that reject together

    def automaton(self):
        found = ahocorasick.Automaton()
        for term in self.soft:
            found.add_word(term, (term, False))
        for term in self.strict:
            found.add_word(term, (term, True))
        if len(found):
            found.make_automaton()
        return found

    def hits(self, automaton, url: str | None) -> tuple[int, int]:
        """Different strict and soft terms with no letter or digit right before or after them."""
        if not url or not len(automaton):
            return 0, 0
        low = url.translate(_LOWER)
        strict, soft = set(), set()
        for end, (term, is_strict) in automaton.iter(low):
            start = end - len(term)
            if (start < 0 or low[start] not in _WORD) and (end + 1 == len(low) or low[end + 1] not in _WORD):
                (strict if is_strict else soft).add(term)
        return len(strict), len(soft)


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], vocabulary: Vocabulary | None = None,
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per input row: host, path, the rule that fits, hits and the verdict.

    A rule's verdict stands; without a rule a URL is blocked on one strict term or on
    ``soft_limit`` different soft ones. Null URLs and those without ``://`` have an empty host and
    path, so no rule fits; the terms are looked for in whatever text there is. Repeated rows are
    judged each; an empty table gives no rows. Nothing is shuffled.
    """
    vocabulary = vocabulary or Vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, known = vocabulary.automaton(), UrlRules(rules)
        for batch in batches:
            rows = []
            for url in batch.column(1).to_pylist():
                host, path = split_url(url)
                fits = known.of(host, path) if host else None
                strict, soft = vocabulary.hits(automaton, url)
                by_terms = "block" if strict or soft >= vocabulary.soft_limit else "allow"
                rows.append((host, path, fits[0] if fits else None, strict, soft, fits[1] if fits else by_terms))
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                names=["page_id", "host", "path", "rule", "n_strict", "n_soft", "verdict"])

    id_type = dict(pages.dtypes)[id_col]
    picked = pages.select(pages[id_col].alias("page_id"), pages[url_col].cast("string").alias("url"))
    return picked.mapInArrow(
        run, f"page_id {id_type}, host string, path string, rule string, n_strict int, n_soft int, verdict string")

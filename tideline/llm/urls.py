"""URL filter: host rules, and a weighted vocabulary of terms counted by Aho-Corasick."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tideline.llm.common import with_columns

# One of these terms in a URL is enough.
STRICT_TERMS = (
    "porn", "xxx", "hentai", "viagra", "cialis", "phishing", "malware", "warez", "spam-farm", "cheap-pills",
)
# So many different ones of these are enough (see ``soft_limit``).
SOFT_TERMS = (
    "adult", "bet", "betting", "bonus", "casino", "cheap", "crack", "farm", "free", "loan", "lottery", "pills",
    "poker", "sex", "slots", "spam", "torrent", "win",
)


@dataclass(frozen=True)
class UrlRules:
    """Host rules as (verdict, ``host/path``) and the vocabulary of the terms."""

    rules: tuple[tuple[str, str], ...] = ()
    strict: tuple[str, ...] = STRICT_TERMS
    soft: tuple[str, ...] = SOFT_TERMS
    soft_limit: int = 2
    by_host: dict = field(init=False, repr=False, compare=False, hash=False, default_factory=dict)

    def __post_init__(self):
        for verdict, rule in self.rules:
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host, []).append((slash + path, rule, verdict))
        for found in self.by_host.values():
            found.sort(key=lambda x: (-len(x[0]), x))


@lru_cache(maxsize=4)
def automaton(strict: tuple[str, ...], soft: tuple[str, ...]) -> ahocorasick.Automaton | None:
    made = ahocorasick.Automaton()
    for term in soft:
        made.add_word(term, (len(term), term, False))
    for term in strict:
        made.add_word(term, (len(term), term, True))
    if not len(made):
        return None
    made.make_automaton()
    return made


LOWER = {upper: upper + 32 for upper in range(ord("A"), ord("Z") + 1)}


def parts(url: str | None) -> tuple[str, str]:
    """Host and path: from behind the first ``://``; both empty without one."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    for end in "?#":
        rest = rest.partition(end)[0]
    host, slash, path = rest.partition("/")
    return host.translate(LOWER), slash + path


def rule_for(rules: UrlRules, host: str, path: str) -> tuple[str | None, str | None]:
    """The longest rule of the host or a parent domain whose path begins the URL's path."""
    best = None
    domain = host
    while domain:
        for prefix, rule, verdict in rules.by_host.get(domain, ()):
            if path.startswith(prefix) and (best is None or len(rule) > len(best[0])):
                best = (rule, verdict)
        domain = domain.partition(".")[2]
    return best or (None, None)


def hits(rules: UrlRules, url: str | None) -> tuple[int, int]:
    """Strict hits, and different soft terms, that stand between non-alphanumeric ASCII or the ends."""
    terms = automaton(rules.strict, rules.soft)
    lowered = (url or "").translate(LOWER)
    strict, soft = 0, set()
    for last, (length, term, is_strict) in terms.iter(lowered) if terms else ():
        before, after = lowered[last - length : last - length + 1] if last >= length else "", lowered[last + 1 : last + 2]
        if not (before.isascii() and before.isalnum() or after.isascii() and after.isalnum()):
            if is_strict:
                strict += 1
            else:
                soft.add(term)
    return strict, len(soft)


OUTPUT = T.StructType(
    [
        T.StructField("host", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("rule", T.StringType()),
        T.StructField("verdict", T.StringType()),
        T.StructField("strict_hits", T.LongType()),
        T.StructField("soft_terms", T.LongType()),
    ]
)


def judge_urls(df: DataFrame, rules: UrlRules, url: str = "url") -> DataFrame:
    """``df`` with host, path, rule, verdict and the counts of terms; one pass, no shuffle.

    A rule decides where one fits; else a URL is blocked for one strict term or ``soft_limit``
    different soft terms. NULL and URLs without ``://`` have empty host and path, no rule, and
    are still searched for terms. Rows, also equal ones, are judged one by one; columns of
    ``df`` that are named like a new one are replaced. An empty table gives an empty one.
    """

    def compute(batch: pa.RecordBatch) -> list:
        rows = []
        for value in batch.column(url).to_pylist():
            host, path = parts(value)
            rule, verdict = rule_for(rules, host, path)
            strict, soft = hits(rules, value)
            blocked = strict > 0 or soft >= rules.soft_limit
            rows.append((host, path, rule, verdict or ("block" if blocked else "allow"), strict, soft))
        return [list(column) for column in zip(*rows)]

    return with_columns(df, url, OUTPUT, compute)


def verdict_sql(rules: UrlRules, table: str) -> str:
    """The same as DuckDB SQL over a table with page_id and url."""
    lowered = "translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def found(term):
        escaped = "".join(c if c.isalnum() else f"\\{c}" for c in term)
        return f"coalesce(regexp_matches({lowered}, '(^|[^a-z0-9]){escaped}($|[^a-z0-9])')::int, 0)"

    fits = []
    for verdict, rule in sorted(rules.rules, key=lambda x: -len(x[1])):
        host, slash, path = rule.partition("/")
        fits.append(
            f"when (host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '{slash + path}') then "
        )
    rule_case = " ".join(f + f"'{r}'" for f, (_, r) in zip(fits, sorted(rules.rules, key=lambda x: -len(x[1]))))
    verdict_case = " ".join(f"when '{r}' then '{v}'" for v, r in rules.rules)
    strict = " + ".join(found(t) for t in rules.strict) or "0"
    soft = " + ".join(found(t) for t in rules.soft) or "0"
    return f"""
    with rest as (
      select page_id, url, case when contains(url, '://')
        then regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*', 0) else '' end as rest from {table}
    ), cut as (
      select page_id, url,
        translate(regexp_extract(coalesce(rest, ''), '^[^/]*', 0),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        substr(coalesce(rest, ''), length(regexp_extract(coalesce(rest, ''), '^[^/]*', 0)) + 1) as path from rest
    ), ruled as (
      select *, case {rule_case} end as rule, {strict} as strict_found, {soft} as soft_terms from cut
    )
    select page_id, host, path, rule, case rule {verdict_case}
      else case when strict_found > 0 or soft_terms >= {rules.soft_limit} then 'block' else 'allow' end end as verdict
    from ruled"""

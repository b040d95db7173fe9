"""URL filter: longest host and path rule first, else a weighted vocabulary counted by Aho-Corasick.

The vocabulary has strict terms, one of which rejects, and soft terms, of which several different ones reject.
A term counts only where no letter or digit touches it on either side.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from urllib.parse import unquote

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Terms that hardly stand in a harmless url, by language, in the plain letters that urls have.
STRICT_BY_LANGUAGE = {
    "en": "porn porno pornstar xxx hentai camgirl camgirls milf gangbang blowjob warez keygen phishing stormer",
    "es": "pornografia porno putas follar casinosonline",
    "fr": "pornographie porno salope putes",
    "de": "pornos pornografie sexcam nutten",
    "it": "pornografia porno troie",
    "pt": "pornografia porno putaria",
}
# Terms that also have harmless uses; several different ones tell what a url is about.
SOFT_BY_LANGUAGE = {
    "en": "adult sex sexy nude naked erotic escort escorts fetish casino betting gambling poker slots jackpot viagra cialis "
    "torrent torrents crack cracked serial gore dating hookup payday",
    "es": "adultos sexo desnuda desnudas erotico apuestas tragaperras ruleta citas",
    "fr": "adulte sexe nue nues erotique paris-sportifs roulette rencontres",
    "de": "erwachsene nackt erotik wetten sportwetten spielautomaten",
    "it": "adulti sesso nuda nude scommesse incontri",
    "pt": "adultos sexo nua nuas apostas roleta encontros",
}


def _terms(by_language: dict[str, str]) -> tuple[str, ...]:
    """The different terms of all languages, sorted."""
    return tuple(sorted({term for terms in by_language.values() for term in terms.split()}))


STRICT, SOFT = _terms(STRICT_BY_LANGUAGE), _terms(SOFT_BY_LANGUAGE)
# Different soft terms that reject.
SOFT_LIMIT = 2

Rule = tuple[str, str]

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = (
    "page_id long, host string, path string, rule string, verdict string, strict_hits long, soft_terms array<string>"
)


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    tail = rest[end:]
    stop = min([i for i in map(tail.find, "?#") if i >= 0], default=len(tail))
    return rest[:end].translate(_UPPER), tail[:stop]


class RuleBook:
    """Rules (verdict, "host/path"); a rule fits its host and all subdomains when the path starts with its path.

    The longest rule that fits wins; of equally long ones a block.
    """

    def __init__(self, rules: list[Rule]) -> None:
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[0] != "block", r[1])):
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host.translate(_UPPER), []).append((slash + path, rule, verdict))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        best: tuple[str, str] | None = None
        while host:
            for start, rule, verdict in self.by_host.get(host, ()):
                if path.startswith(start):
                    if not best or (len(rule), verdict == "block") > (len(best[0]), best[1] == "block"):
                        best = rule, verdict
                    break
            host = host.partition(".")[2]
        return best


class Vocabulary:
    """Strict and soft terms in one automaton, A-Z lower-cased like urls; a term in both is strict."""

    def __init__(self, strict: tuple[str, ...], soft: tuple[str, ...]) -> None:
        self.terms = ahocorasick.Automaton()
        for terms, severe in ((soft, False), (strict, True)):
            for term in (t.translate(_UPPER) for t in terms):
                self.terms.add_word(term, (term, severe))
        self.empty = not len(self.terms)
        if not self.empty:
            self.terms.make_automaton()

    def count(self, url: str | None) -> tuple[int, list[str]]:
        """Strict hits, and the different soft terms, in the lower-cased and percent-decoded url."""
        if not url or self.empty:
            return 0, []
        text = unquote(url, errors="replace").translate(_UPPER)
        strict, soft = 0, set()
        for end, (term, severe) in self.terms.iter(text):
            before = text[end - len(term)] if end >= len(term) else " "
            after = text[end + 1] if end + 1 < len(text) else " "
            if not before.isalnum() and not after.isalnum():
                strict += severe
                if not severe:
                    soft.add(term)
        return strict, sorted(soft)


def _judge(
    rules: list[Rule], strict: tuple[str, ...], soft: tuple[str, ...], limit: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, terms = RuleBook(rules), Vocabulary(strict, soft)
        kinds = [pa.string()] * 4 + [pa.int64(), pa.list_(pa.string())]
        names = ["page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_terms"]
        for batch in batches:
            rows = []
            for value in batch.column(1):
                url = value.as_py()
                host, path = split_url(url)
                found = book.find(host, path)
                hits, several = terms.count(url)
                own = "block" if hits or len(several) >= limit else "allow"
                rows.append((host, path, found and found[0], found[1] if found else own, hits, several))
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    return run


def filter_urls(
    pages: DataFrame,
    rules: list[Rule],
    strict: tuple[str, ...] = STRICT,
    soft: tuple[str, ...] = SOFT,
    soft_limit: int = SOFT_LIMIT,
) -> DataFrame:
    """One row per page (page_id, url, …): host, path, the rule that decided or null, verdict, and the counts.

    A null or empty url has empty host and path, no hits, and is allowed. Repeated rows each get a row; other
    columns, html included, are not read. Rules and terms are parameters and travel with the tasks.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    return rows.mapInArrow(_judge(list(rules), tuple(strict), tuple(soft), soft_limit), SCHEMA)

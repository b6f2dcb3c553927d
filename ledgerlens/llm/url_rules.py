"""URL filter: pattern rules filed under their rarest literal token.

Every rule names literal tokens that any url it matches must hold. Tokens are counted over all
urls, each rule is filed under its rarest one, a url fetches the rules filed under its tokens, and
only those run their regular expression. DataFrame functions only. Rules are broadcast while there
are at most ``BROADCAST_RULES`` of them, so a frequent token of the urls is not shuffled; beyond
that the optimizer chooses the join."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOKEN_END = r"[^0-9A-Za-z]+"
BROADCAST_RULES = 20_000
_RULES = "array<struct<rule:string,verdict:string,pattern:string,site:boolean,part:string,literals:array<string>>>"


@dataclass(frozen=True)
class SiteRule:
    """Fits a host and its subdomains where the path starts with the rule's (``net/``)."""

    rule: str
    verdict: str

    @property
    def pattern(self) -> str:
        host, slash, path = self.rule.partition("/")
        return r"\A(?:[^/]*\.)?" + re.escape(host) + re.escape(slash + path)

    @property
    def literals(self) -> tuple[str, ...]:
        # The last token of a rule may go on in the url unless the rule ends it.
        whole = self.rule if not self.rule[-1:].isalnum() else re.sub(r"[0-9A-Za-z]+\Z", "", self.rule)
        return tuple(t for t in re.split(_TOKEN_END, whole) if t)


@dataclass(frozen=True)
class PatternRule:
    """A regular expression and tokens that every match holds whole. ``part`` is what it reads: host
    and path, the path with ``/`` behind it, or the query with its ``?``; the latter two lower-cased."""

    rule: str
    pattern: str
    literals: tuple[str, ...]
    verdict: str = "block"
    part: str = "host"


# Words by family, for hosts, whole path segments and query keys.
HOST_WORDS = {
    "adult": "adulto escort escorts erotic erotica fetish hentai hookup milf naked nude nudes porn porno sexcam"
    " sexchat webcamsex xxx camgirls livecams swingers",
    "advertising": "adclick adclicks adnetwork adserver adservers adservice adtrack adtracker advertising affiliates"
    " banners clickbank clicktrack doubleclick popads popunder popup remarketing retarget sponsored tracker",
    "betting": "baccarat betting blackjack bookmaker bookmakers casinos jackpot lottery lotto poker roulette slots"
    " sportsbet sportsbook gambling wager freespins",
    "malware": "crack cracks cracked hacktool keygen keygens malware phishing ransomware serials spyware trojan warez"
    " botnet exploitkit cardersforum",
    "spam": "doorway linkfarm linkfarms scam scams spammer spammers spamlist bulkmail backlinks autoblog splog",
    "piracy": "camrip dvdrip freedownloads nulled pirated piratebay torrent torrents streamfree megadownload",
    "payday": "debtrelief fastcash paydayloan paydayloans payday quickloan quickloans instantloan forexbot"
    " binaryoptions getrich easymoney ponzi",
}
DRUGS = (
    "ambien cialis codeine hydrocodone levitra modafinil oxycontin percocet phentermine propecia soma tramadol valium"
    " viagra vicodin xanax steroids hgh"
)
SELLERS = "buy cheap online discount order"
PATH_WORDS = {
    "login": "login signin signup register logout password-reset wp-admin wp-login administrator cpanel phpmyadmin",
    "shop": "cart checkout basket wishlist add-to-cart my-account order-status",
    "advertising": "adclick adframe adserver advert adverts banner banners popunder sponsored outbound-ads",
    "adult": "escorts hentai nude nudes porn porno sexcam webcams-xxx xxx",
    "betting": "betting blackjack casino poker roulette slots sportsbook",
    "trap": "cgi-bin calendar-export print-version trackback xmlrpc session-expired captcha",
}
QUERY_KEYS = {
    "session": "jsessionid phpsessid sessionid session_id sid",
    "affiliate": "aff aff_id affid affiliate affiliate_id clickid click_id subid",
    "trap": "add-to-cart replytocom share redirect_to return_to",
}


def _literals(text: str) -> tuple[str, ...]:
    return tuple(t for t in re.split(_TOKEN_END, text) if t)


def word_rules() -> tuple[PatternRule, ...]:
    """One rule per word of the lists above and per seller and drug."""
    hosts = [(family, w) for family, words in HOST_WORDS.items() for w in words.split()]
    hosts += [("drugs", w) for w in DRUGS.split()]
    hosts += [("drugs", f"{a}-{b}-pharmacy") for a in SELLERS.split() for b in DRUGS.split()]
    paths = [(family, w) for family, words in PATH_WORDS.items() for w in words.split()]
    keys = [(family, w) for family, words in QUERY_KEYS.items() for w in words.split()]
    return (
        *(PatternRule(f"{f} host {w}", rf"\A(?:[^/]*[.-])?{w}[.-]", _literals(w)) for f, w in hosts),
        *(PatternRule(f"{f} path {w}", f"/{w}/", _literals(w), part="path") for f, w in paths),
        *(PatternRule(f"{f} query {w}", f"[?&;]{w}=", _literals(w), part="query") for f, w in keys),
    )


SITE_RULES = (
    SiteRule("net/", "block"),
    SiteRule("example.net/en/", "allow"),
    SiteRule("example.com/de/", "block"),
    SiteRule("org/fr/", "allow"),
)
PATTERN_RULES = (
    PatternRule("spam host", r"\A(?:[^/]*[.-])?spam(?:-[^./]*)?\.", ("spam",)),
    PatternRule("pills host", r"\A(?:[^/]*[.-])?(?:cheap|buy|online)-pills[.-]", ("pills",)),
    PatternRule("casino host", r"\A(?:[^/]*[.-])?casino[.-]", ("casino",)),
    PatternRule("ad host", r"\A(?:[^/]*\.)?ads[.-]", ("ads",)),
    PatternRule("adult host", r"\A(?:[^/]*[.-])?adult[.-]", ("adult",)),
    PatternRule("betting host", r"\A(?:[^/]*[.-])?bets[.-]", ("bets",)),
    *word_rules(),
)


def _lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def with_host_and_path(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``, and the query with its ``?`` as ``__query``; all empty for a null url
    or one without ``://``."""
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    rest = F.when(F.instr(text, "://") > 0, F.expr("substring(__u, instr(__u, '://') + 3)")).otherwise("")
    raw_host = F.regexp_extract("__rest", r"\A[^/?#]*", 0)
    return (
        pages.withColumn("__u", text)
        .withColumn("__rest", rest)
        .withColumn("__host", raw_host)
        .withColumn("path", F.regexp_extract(F.expr("substring(__rest, length(__host) + 1)"), r"\A[^?#]*", 0))
        .withColumn("__query", F.regexp_extract(F.expr("substring(__rest, length(__host) + length(path) + 1)"), r"\A\?[^#]*", 0))
        .withColumn("host", _lower(F.col("__host")))
        .drop("__u", "__rest", "__host")
    )


def _tokens() -> Column:
    """Distinct tokens as they stand, for site rules, and those of path and query in lower case."""
    lower = _lower(F.concat("path", "__query"))
    both = F.concat_ws(" ", F.concat("host", "path"), lower)
    return F.array_distinct(F.filter(F.split(both, _TOKEN_END, -1), lambda t: t != ""))


def _subject() -> Column:
    """What a rule reads of a url."""
    return (
        F.when(F.col("part") == "path", F.concat(_lower(F.col("path")), F.lit("/")))
        .when(F.col("part") == "query", _lower(F.col("__query")))
        .otherwise(F.concat("host", "path"))
    )


def _small(of_rules: DataFrame, rules: int) -> DataFrame:
    return F.broadcast(of_rules) if rules <= BROADCAST_RULES else of_rules


def rule_index(urls: DataFrame, site_rules, pattern_rules) -> DataFrame:
    """One row per rule with the literal it is filed under; as many rows as rules."""
    rules = [(r.rule, r.verdict, r.pattern, isinstance(r, SiteRule), getattr(r, "part", "host"), list(r.literals)) for r in (*site_rules, *pattern_rules)]
    bare = [r[0] for r in rules if not r[-1]]
    if bare:
        raise ValueError(f"rules without a literal token: {bare}")
    names = ("rule", "verdict", "pattern", "site", "part", "literals")
    listed = json.dumps([dict(zip(names, r)) for r in rules])
    table = urls.sparkSession.range(1).select(F.inline(F.from_json(F.lit(listed), _RULES)))
    literals = _small(table.select(F.explode("literals").alias("literal")).distinct(), len(rules))
    seen = (
        urls.select(F.explode(_tokens()).alias("literal"))
        .join(literals, "literal", "left_semi")
        .groupBy("literal")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        table.withColumn("literal", F.explode("literals"))
        .join(seen, "literal", "left")
        .groupBy("rule", "verdict", "pattern", "site", "part")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "literal"))["literal"].alias("literal"))
    )


def judge(
    pages: DataFrame,
    url: str = "url",
    keep: list[str] | None = None,
    site_rules=SITE_RULES,
    pattern_rules=PATTERN_RULES,
    default: str = "allow",
) -> DataFrame:
    """One row per input row: the ``keep`` columns (all by default), ``host``, ``path``, ``rule``
    (the longest fitting site rule, else null), ``verdict`` (that rule's; else ``block`` if a
    blocking pattern rule matches, ``allow`` if only allowing ones do, else ``default``) and
    ``matched`` (sorted names of matching pattern rules).

    Null urls and urls without ``://`` have empty parts, no rule and the default verdict; repeated
    rows stay apart; of fitting site rules of equal length the larger text counts; columns named
    like an added one are replaced; empty tables give no rows."""
    keep = pages.columns if keep is None else keep
    names = {"host", "path", "rule", "verdict", "matched"}
    kept = [c for c in keep if c.lower() not in names]
    urls = with_host_and_path(pages.select(*(F.col(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(kept)), F.col(url).alias("__url")), "__url").drop("__url")
    index = rule_index(urls.select("host", "path", "__query"), site_rules, pattern_rules)
    index = _small(index, len(site_rules) + len(pattern_rules))
    # The empty token keeps urls that fetch nothing; partial aggregation brings every url back to
    # one row before the shuffle.
    fetched = (
        urls.withColumn("__row", F.monotonically_increasing_id())
        .withColumn("literal", F.explode(F.array_append(_tokens(), F.lit(""))))
        .join(index, "literal", "left")
        .withColumn("hit", F.rlike(_subject(), F.col("pattern")))
    )
    site = F.when(
        F.col("hit") & F.col("site"),
        F.struct(F.length("rule").alias("size"), "rule", "verdict"),
    )
    pattern = F.col("hit") & ~F.col("site")
    per_row = fetched.groupBy("__row", *(f"__k{i}" for i in range(len(kept))), "host", "path").agg(
        F.max(site).alias("best"),
        F.sort_array(F.collect_set(F.when(pattern, F.col("rule")))).alias("matched"),
        F.coalesce(F.bool_or(pattern & (F.col("verdict") == "block")), F.lit(False)).alias("blocked"),
        F.coalesce(F.bool_or(pattern & (F.col("verdict") == "allow")), F.lit(False)).alias("allowed"),
    )
    verdict = F.when(F.col("blocked"), "block").when(F.col("allowed"), "allow").otherwise(default)
    return per_row.select(
        *(F.col(f"__k{i}").alias(c) for i, c in enumerate(kept)),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", verdict).alias("verdict"),
        "matched",
    )

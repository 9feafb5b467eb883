"""Ordered rules that flag rows with a reason; no rule removes a row.

Rules are data: a name list or a pattern, and the reason. The first that holds
gives its reason. A lexicon's order decides which of several hits is named.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.fixed import BUNDLE, BUNDLED, CRIME, IRRELEVANT, PROMOTION, SPORTS
from ..functions.text import col, words


def hits(text: Column | str, lexicon: Sequence[str]) -> Column:
    """The lexicon's entries that occur in ``text``, in its order."""
    t = col(text)
    return F.filter(words(lexicon), lambda k: F.contains(t, k))


def has(text: Column | str, lexicon: Sequence[str]) -> Column:
    """Whether any entry occurs; a chain of built-in tests, no array."""
    t = col(text)
    return reduce(lambda a, k: a | F.contains(t, F.lit(k)), lexicon, F.lit(False))


def maximal(found: Column | str) -> Column:
    """Entries that no longer entry contains."""
    f = col(found)
    return F.filter(f, lambda x: ~F.exists(f, lambda y: (F.char_length(y) > F.char_length(x)) & F.contains(y, x)))


@dataclass(frozen=True)
class Rule:
    """Holds if ``when`` does. ``because`` is the reason, or an expression of it."""

    name: str
    when: Column
    because: Column | str


def reason(rules: Sequence[Rule]) -> Column:
    """Of the first rule that holds; null if none does. A rule with a null reason lets the row pass."""
    out = None
    for r in rules:
        why = F.lit(r.because) if isinstance(r.because, str) else r.because
        out = F.when(r.when, why) if out is None else out.when(r.when, why)
    return out


def flagged(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``df`` with excluded and exclude_reason."""
    return df.withColumn("exclude_reason", reason(rules)).withColumn("excluded", F.col("exclude_reason").isNotNull())


def named(lead: str, found: Column, tail: str = "") -> Column:
    """Reason with the first entry found: lead(entry tail)."""
    return F.concat(F.lit(f"{lead}("), F.try_element_at(found, F.lit(1)), F.lit(f"{tail})"))


@dataclass(frozen=True)
class Lexicons:
    """Names and words of a site. Empty lists switch a rule off."""

    companies: Sequence[str] = ()
    relevance: Sequence[str] = ()
    not_ours: Sequence[str] = ()
    exempt_companies: Sequence[str] = ()  # of which every piece of news is relevant, but for ``exempt_noise``
    exempt_noise: Sequence[str] = ()
    stock_reports: Sequence[str] = ()
    broker_patterns: Sequence[str] = ()
    investment_tags: Sequence[str] = ()
    column_patterns: Sequence[str] = ()
    forecast_houses: Sequence[str] = ()
    forecast_words: Sequence[str] = ()
    personnel: Sequence[str] = ()
    roundup_tags: Sequence[str] = ()
    roundup_tails: Sequence[str] = (r"(外|等)\s*$", r"\s(外|等)(?=[\s\"'’”]|$)")
    bundles: Sequence[str] = ()
    noise: Sequence[str] = ()
    noise_patterns: Sequence[str] = ()
    sports: Sequence[str] = ()
    crime: Sequence[str] = ()
    security: Sequence[str] = ()
    promotion: Sequence[str] = ()
    hard: Sequence[str] = ()
    hard_patterns: Sequence[str] = ()
    anecdote: tuple[str, str] = ("", "")  # a word, and a pattern that must hold with it
    other_topics: Sequence[str] = ()
    core: Sequence[str] = ()
    substantive: Sequence[str] = ()
    sector_words: Sequence[str] = ()
    digital_words: Sequence[str] = ()
    topic_menu: str = ""
    policy_menu: str = ""  # empty switches the rules for policy searches off
    policy_words: Sequence[str] = ()
    separators: str = r"[·,/ㆍ|…]"
    tag: str = r"^\s*[\[【]"


@dataclass(frozen=True)
class Screen:
    """The rules on titles, in their order."""

    lex: Lexicons = field(default_factory=Lexicons)

    def any(self, text: Column, patterns: Sequence[str]) -> Column:
        return reduce(lambda a, p: a | F.coalesce(text.rlike(p), F.lit(False)), patterns, F.lit(False))

    def roundup(self, title: Column) -> Column:
        """Whether a title lists several stories."""
        many = title.rlike(self.lex.tag) & (F.regexp_count(title, F.lit(self.lex.separators)) >= 2)
        return self.any(title, self.lex.roundup_tags) | self.any(title, self.lex.roundup_tails) | many

    def topic_rules(self, title: Column) -> list[Rule]:
        """For rows that a topic search found: a word of the sector and one of the topic."""
        x = self.lex
        return [
            Rule("personnel", self.any(title, x.personnel), f"{IRRELEVANT}(인사·부고)"),
            Rule("broker", self.any(title, x.broker_patterns), f"{IRRELEVANT}(증권사 종목 리포트)"),
            Rule("hard", self.any(title, x.hard_patterns) | has(title, x.hard), f"{IRRELEVANT}(프로모션·수상·상품)"),
            Rule("roundup", self.roundup(title), f"{IRRELEVANT}({BUNDLED})"),
            Rule("column", self.any(title, x.column_patterns) | self.any(title, x.investment_tags), f"{IRRELEVANT}(시황 코너)"),
            Rule("sector", ~has(title, x.sector_words), f"{IRRELEVANT}(업계동향이나 업권어 없음)"),
            Rule("digital", ~has(title, x.digital_words), f"{IRRELEVANT}(업계동향이나 디지털 맥락 없음)"),
        ]

    def policy_rules(self, title: Column) -> list[Rule]:
        """For rows that a policy search found: one story, no market column, and a word of the digital context."""
        x = self.lex
        return [
            Rule("roundup", self.roundup(title), f"{IRRELEVANT}({BUNDLED})"),
            Rule("column", self.any(title, x.column_patterns) | self.any(title, x.investment_tags), f"{IRRELEVANT}(시황 코너)"),
            Rule("digital", ~has(title, x.policy_words), f"{IRRELEVANT}(정책이나 제목에 디지털 맥락 없음)"),
        ]

    def title_rules(self, title: Column) -> list[Rule]:
        x = self.lex
        found = hits(title, x.companies)
        n = F.size(maximal(found))
        several = F.concat(F.lit(f"{BUNDLE}("), n.cast("string"), F.lit("개사 나열)"))
        bundle = self.any(title, x.bundles)
        masked = reduce(lambda t, k: F.replace(t, F.lit(k), F.lit("")), x.not_ours, title)
        passes = F.lit(None).cast("string")
        word, pattern = x.anecdote
        rules = [
            Rule("stock", has(title, x.stock_reports), F.concat(F.lit(f"{IRRELEVANT}(주식·리포트: "), F.try_element_at(hits(title, x.stock_reports), F.lit(1)), F.lit(")"))),
            Rule("broker", self.any(title, x.broker_patterns), f"{IRRELEVANT}(증권사 종목 리포트)"),
            Rule("investment", self.any(title, x.investment_tags), f"{IRRELEVANT}(투자·증시 코너)"),
            Rule("column", self.any(title, x.column_patterns), f"{IRRELEVANT}(크립토 시황 코너)"),
            Rule("forecast", has(title, x.forecast_houses) & has(title, x.forecast_words), f"{IRRELEVANT}(기관 시황 전망)"),
            Rule("personnel", self.any(title, x.personnel), f"{IRRELEVANT}(인사·부고)"),
            Rule("roundup", self.roundup(title), f"{IRRELEVANT}({BUNDLED})"),
            Rule("bundle without a name", bundle & (n == 0), f"{BUNDLED}(단일 주체 없음)"),
            Rule("bundle", (bundle & (n >= 2)) | (n >= 4), several),
            Rule("noise", has(title, x.noise), F.concat(F.lit(f"{IRRELEVANT}(제목 노이즈: "), F.try_element_at(hits(title, x.noise), F.lit(1)), F.lit(")"))),
            Rule("noise pattern", self.any(title, x.noise_patterns), f"{IRRELEVANT}(퀴즈·이벤트성 제목)"),
            Rule("sports", has(title, x.sports), named(SPORTS, hits(title, x.sports))),
            Rule("crime", has(title, x.crime) & ~has(title, x.security), named(CRIME, hits(title, x.crime))),
            Rule("no company", ~has(title, x.companies), f"{IRRELEVANT}(제목에 대상 금융사 없음)"),
            Rule("not ours", has(title, x.not_ours) & ~has(masked, x.companies), F.concat(F.lit(f"{IRRELEVANT}(대상 아닌 업체: "), F.try_element_at(hits(title, x.not_ours), F.lit(1)), F.lit(")"))),
            Rule("hard", has(title, x.hard), named(IRRELEVANT, hits(title, x.hard))),
            Rule("anecdote", F.contains(title, F.lit(word)) & title.rlike(pattern) if word else F.lit(False), f"{IRRELEVANT}(보이스피싱 예방 미담)"),
            Rule("exempt noise", has(title, x.exempt_companies) & has(title, x.exempt_noise), named(IRRELEVANT, hits(title, x.exempt_noise))),
            Rule("relevant", has(title, x.relevance), passes),
        ]
        for p in x.hard_patterns:
            rules.append(Rule("hard pattern", title.rlike(p), F.concat(F.lit(f"{IRRELEVANT}(규제·수상·시황: "), F.left(F.regexp_extract(title, p, 0), F.lit(12)), F.lit(")"))))
        return [*rules, Rule("other topic", has(title, x.other_topics), named(IRRELEVANT, hits(title, x.other_topics), " 기사"))]

    def screen(self, df: DataFrame, title: str = "title", menu: str | None = None) -> DataFrame:
        """``df`` with excluded, exclude_reason and needs_body_check; rows of a topic or policy search (``menu``) have rules of their own."""
        x, t = self.lex, F.coalesce(F.col(title), F.lit(""))
        found_by = lambda name: F.coalesce(F.col(menu) == name, F.lit(False)) if menu and name else F.lit(False)
        topical, policy = found_by(x.topic_menu), found_by(x.policy_menu)
        why = F.when(topical, reason(self.topic_rules(t))).when(policy, reason(self.policy_rules(t))).otherwise(reason(self.title_rules(t)))
        sure = topical | policy | has(t, x.relevance) | has(t, x.exempt_companies)
        return df.withColumn("exclude_reason", why).withColumn("excluded", F.col("exclude_reason").isNotNull()).withColumn("needs_body_check", ~F.col("excluded") & ~sure)

    def filter_bodies(self, df: DataFrame, title: str = "title", body: str = "body", menu: str | None = None, *, empty: bool = True) -> DataFrame:
        """``df`` after the rules on bodies: first 400 characters for the topic, 800 for the rest. Rows already excluded keep their reason.

        A row of a policy search that needs its body checked is judged by its digital context alone. Without ``empty``
        rows without a body have no reason of their own, but that of a body without the topic.
        """
        x, b = self.lex, F.coalesce(F.col(body), F.lit(""))
        lead, text = F.left(b, F.lit(400)), F.concat(F.coalesce(F.col(title), F.lit("")), F.lit(" "), F.left(b, F.lit(800)))
        sports = hits(text, x.sports)
        policy = F.col("needs_body_check") & (F.coalesce(F.col(menu) == x.policy_menu, F.lit(False)) if menu and x.policy_menu else F.lit(False))
        rules = [
            Rule("already", F.col("excluded"), F.col("exclude_reason")),
            Rule("no body", F.lit(empty) & F.col("needs_body_check") & (b == ""), f"{IRRELEVANT}(제목·본문에서 디지털·AI 근거 없음)"),
            Rule("policy", policy, F.when(~has(lead, x.policy_words), f"{IRRELEVANT}(정책이나 디지털·AI 아님)")),
            Rule("topic", F.col("needs_body_check") & ~has(lead, x.core), f"{IRRELEVANT}(본문 확인: 디지털·AI 내용 아님)"),
            Rule("sports", F.size(sports) >= 2, F.concat(F.lit(f"{SPORTS}("), F.array_join(F.slice(sports, 1, 2), ","), F.lit(")"))),
            Rule("crime", has(text, x.crime) & ~has(text, x.security), named(CRIME, hits(text, x.crime))),
            Rule("promotion", has(text, x.promotion) & ~has(text, x.substantive), named(PROMOTION, hits(text, x.promotion))),
        ]
        return df.withColumn("exclude_reason", reason(rules)).withColumn("excluded", F.col("exclude_reason").isNotNull())


def reason_key(why: Column | str) -> Column:
    """What stands before the bracket; without a reason, the rest."""
    return F.coalesce(F.substring_index(col(why), "(", 1), F.lit("기타"))


def reason_counts(df: DataFrame, why: str = "exclude_reason") -> DataFrame:
    return df.where("excluded").groupBy(reason_key(why).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def ledger(df: DataFrame) -> DataFrame:
    """One row: raw = final + excluded, how the excluded rows divide, and what failed.

    Columns that a frame doesn't have yet (needs_body_check, extract_ok, summary_ok) count as nothing.
    """
    return df.agg(*ledger_counts(df))


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with the ledger's counters on it: the action that next runs through it fills them, without another pass."""
    counts = Observation()
    return df.observe(counts, *ledger_counts(df)), counts


def ledger_counts(df: DataFrame) -> list[Column]:
    key = reason_key("exclude_reason")
    has_col = lambda c: F.col(c) if c in df.columns else F.lit(None)
    live = ~F.col("excluded")
    said_no = has_col("reviewed") == "NO"
    return [
        F.count(F.lit(1)).alias("raw"),
        F.count_if(live).alias("final"),
        F.count_if(F.col("excluded")).alias("excluded"),
        F.count_if(F.col("excluded") & (key == "중복")).alias("duplicates"),
        F.count_if(F.col("excluded") & (key == "기열람")).alias("seen"),
        F.count_if(F.col("excluded") & ~key.isin("중복", "기열람")).alias("screened"),
        F.count_if(live & (has_col("extract_ok").cast("int") == 0)).alias("extract_fail"),
        F.count_if(live & ~has_col("summary_ok").cast("boolean")).alias("summary_fail"),
        *([F.count_if(said_no).alias("review_no")] if "reviewed" in df.columns else []),
    ]

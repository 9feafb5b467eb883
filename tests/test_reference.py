"""Functions and operators on worked examples, and joins and clusters against brute force."""

import difflib
import json
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from siftmill.functions import summaries as S
from siftmill.functions import text as T
from siftmill.operators import dedup, entities, history, reports, rules
from siftmill.operators.clusters import components, ordered_clusters, stars
from siftmill.operators.pairs import fingerprint_links, near_fingerprints, similar_titles, token_links, token_pairs, token_pairs_between
from siftmill.sources import search
from siftmill.sources.store import Store, load_config, publish, write_csv
from siftmill.streaming import incremental


def one(spark, column, **values):
    kinds = {str: "string", int: "long", list: "array<string>", type(None): "string", datetime: "timestamp"}
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items())) if values else spark.range(1)
    return df.select(column.alias("x")).first()[0]


# -- functions ---------------------------------------------------------------------
def test_titles(spark):
    norm = lambda t: one(spark, T.normalize_title("t", ["[단독]"]), t=t)
    assert norm("[단독] 신한·하나은행, AI 공동개발") == "신한 하나은행 ai 공동개발"
    assert norm("  [속보]  'KB'  Pay!") == "kb pay"
    assert norm(None) == "" and norm("네이버 é_1!") == "네이버 é_1"
    bare = lambda t: one(spark, T.strip_particle(F.col("t")), t=t)
    assert [bare(t) for t in ("공무원연금공단과", "네이버페이", "네이버페이와", "가는")] == ["공무원연금공단", "네이버페이", "네이버페이", "가는"]
    assert sorted(one(spark, T.title_tokens("t"), t="신한은행과 ai 171억 투자 확대 a")) == ["171억", "ai", "신한은행", "투자"]


def test_overlaps(spark):
    ov = lambda f, a, b: one(spark, f("a", "b"), a=a, b=b)
    assert ov(T.overlap, ["a", "b"], ["b", "c", "d"]) == 0.5 and ov(T.overlap, [], ["b"]) == 0.0
    assert ov(T.content_overlap, ["a", "b"], ["b", "c"]) == 0.0 and ov(T.content_overlap, ["a", "b", "c"], ["b", "c"]) == 1.0
    assert one(spark, T.content_tokens("a", "b"), a=["kb", "출시", "송금"], b=["kb"]) == ["송금"]


def test_urls_and_dates(spark):
    url = lambda u: one(spark, T.clean_url("u"), u=u)
    assert url("http://h/articleView.html?utm_source=x&idxno=255567#top") == "http://h/articleView.html?idxno=255567"
    assert url(" http://h/a/?b=2&a=1&ref=z ") == "http://h/a/?a=1&b=2" and url("http://h/a/?gclid=1") == "http://h/a" and url(None) == ""
    assert one(spark, T.parse_rfc_date("d"), d="Thu, 23 Jul 2026 14:41:00 +0900") == datetime(2026, 7, 23, 5, 41)
    assert one(spark, T.parse_rfc_date("d"), d="soon") is None
    assert one(spark, T.parse_digits_date("d"), d="2026.07.23 등록") == datetime(2026, 7, 23) and one(spark, T.parse_digits_date("d"), d="12") is None


def test_bodies(spark):
    assert one(spark, T.strip_tags("h"), h="<b>A &amp; B</b> ") == "A & B"
    assert one(spark, T.clean_body("t"), t="본문  내용. a.b@c.kr 무단 전재 금지") == "본문 내용."
    html = "<html><article class=x><p>one</p><script>var x=1</script> two</article><p>" + "three " * 60 + "</p></html>"
    assert one(spark, T.article_text("h"), h=html) == "one two"
    assert one(spark, T.body_text("h"), h=html).startswith("one three") and one(spark, T.body_text("h"), h="<p>x</p>") is None


def test_simhash(spark):
    import hashlib

    texts = ["", "a b", "디지털 금융 digital bank 디지털", "one two three two"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, body string")
    got = {r.id: r.fp for r in T.fingerprints(df, "body").collect()}
    for i, t in enumerate(texts):
        import re

        toks = re.findall(r"[가-힣]{2,}|[a-zA-Z]{3,}", t.lower())
        hs = [int(hashlib.md5(x.encode()).hexdigest(), 16) for x in toks]
        fp = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
        assert got[i] == (fp - (1 << 64) if fp >> 63 else fp)


# -- summaries --------------------------------------------------------------------------
def test_summaries(spark):
    lines = ("출범했다", "제공할 계획이다", "추진하고 있다", "서비스를 선보이겠다.", "논의함", "합의함", "동의함", "기능 포함", "물품 보관함", "지원 필요임", "도입됨", "개최한다고 밝혔다", "", "고객을")
    ended = ["출범", "제공 예정", "추진 중", "서비스를 선보이겠다는 계획", "논", "합", "동", "기능 포함", "물품 보관함", "지원 필요", "도입", "개최", "", "고객"]
    assert one(spark, F.transform("l", S.noun_ending), l=list(lines)) == ended
    assert one(spark, S.compact("t", 20), t="첫 문장이다. 둘째 문장이다. 셋째 문장이다.") == "첫 문장이다. 둘째 문장이다."
    assert one(spark, S.compact("t", 4), t="첫 문장이다. 둘째") == "첫 문장" and one(spark, S.compact("t", 99), t=None) == ""
    assert one(spark, S.is_grounded("s", "t"), s="은행 출시 출시", t="은행이 서비스를 출시") and not one(spark, S.is_grounded("s", "t"), s="1", t="x")
    assert one(spark, S.bullets("t"), t="* a\n\n• b\n- c\nd\ne") == ["- a", "- b", "- c", "d"]
    v = lambda *ls: tuple(one(spark, S.validated("t"), t="\n".join(ls)))
    good = "- 신한은행 디지털 자산 서비스 출시"
    assert v(good, "* 기업 고객 대상 송금을 지원했다.") == (good + "\n- 기업 고객 대상 송금을 지원", None)
    assert [v(*x)[1] for x in ([good], [good, "없음 불릿 하나도 없는 줄"], [good, "- 짧다"], ["- 새로운 서비스를 공개하는 방향 -함", good])] == ["줄 수 부족(1줄)", "불릿 없음: 없음 불릿 하나도 없는 줄", "짧은 줄(4자): 짧다", None]
    assert v("- 새로운 서비스를 공개하는 방향인 것으로 보인다고 한다는 말이 있다", good)[1].startswith("어미 미보정('있다')")
    assert [one(spark, S.retry_wait(F.lit(n))) for n in (0, 2, 9)] == [2.0, 8.0, 30.0]


# -- rules ----------------------------------------------------------------------------------
LEX = rules.Lexicons(
    companies=["하나은행", "신한은행", "하나카드", "케이뱅크", "KB국민은행", "KB국민", "토스", "NH농협은행"], relevance=["AI", "디지털"], not_ours=["앱토스랩스"], exempt_companies=["토스"],
    exempt_noise=["인수"], stock_reports=["목표주가"], personnel=[r"\[인사\]"], bundles=[r"^\[오늘의"], noise=["퀴즈"], sports=["야구", "농구"], crime=["횡령"], security=["보안"],
    promotion=["이벤트"], hard=["채용"], hard_patterns=[r"과징금\s*부과"], anecdote=("보이스피싱", "막은|예방"), other_topics=["봉사"], core=["핀테크"], substantive=["AI"],
    sector_words=["보험업"], digital_words=["AI"], topic_menu="industry",
)


def test_lines_lose_spaces_only(spark):
    assert one(spark, S.bullets("t"), t="0997 도입됨 \n  1 둘째 1\n2 셋") == ["0997 도입됨", "1 둘째 1", "2 셋"]


def screened(spark, *titles, menu=None):
    df = spark.createDataFrame([(i, t, menu, None) for i, t in enumerate(titles)], "id long, title string, menu_id string, body string")
    return [(r.exclude_reason, r.needs_body_check) for r in rules.Screen(LEX).screen(df, menu="menu_id").orderBy("id").collect()]


def test_screen(spark):
    got = screened(
        spark, "하나은행, AI 기반 금리 산정", "삼성전자 목표주가 상향", "[인사] 하나은행", "[단신] 하나은행·신한은행·케이뱅크", "[오늘의 금융] 시장", "[오늘의 은행] 하나은행 신한은행",
        "하나은행 신한은행 케이뱅크 하나카드", "하나은행 퀴즈", "하나은행 야구", "하나은행 횡령", "하나은행 횡령 보안 AI", "삼성전자 AI", "앱토스랩스 AI", "하나은행 채용 AI",
        "하나은행 보이스피싱 막은 직원", "토스 AI 인수", "하나은행 과징금 부과", "하나은행 봉사", "토스 소식지", "하나은행 소식지", "[뉴스_하나카드] 카드 디자인", "", "KB국민은행 AI",
    )
    assert got == [
        (None, False), ("무관(주식·리포트: 목표주가)", False), ("무관(인사·부고)", False), ("무관(묶음기사)", False), ("묶음기사(단일 주체 없음)", False), ("종합기사(2개사 나열)", False),
        ("종합기사(4개사 나열)", False), ("무관(제목 노이즈: 퀴즈)", False), ("스포츠(야구)", False), ("범죄(횡령)", False), (None, False), ("무관(제목에 대상 금융사 없음)", False),
        ("무관(대상 아닌 업체: 앱토스랩스)", False), ("무관(채용)", False), ("무관(보이스피싱 예방 미담)", False), ("무관(인수)", False), ("무관(규제·수상·시황: 과징금 부과)", False),
        ("무관(봉사 기사)", False), (None, False), (None, True), (None, True), ("무관(제목에 대상 금융사 없음)", False), (None, False),
    ]
    assert screened(spark, "보험업 AI 활용 '걸음마'", "보험업 걸음마", "AI 활용", menu="industry") == [(None, False), ("무관(업계동향이나 디지털 맥락 없음)", False), ("무관(업계동향이나 업권어 없음)", False)]


def test_bodies_filter_and_ledger(spark):
    rows = [(0, "하나은행 소식지", None), (1, "하나은행 소식지", "x" * 400 + "핀테크"), (2, "하나은행 소식지", "핀테크 야구 농구"), (3, "하나은행 소식지", "핀테크 야구"), (4, "하나은행 소식지", "핀테크 이벤트"), (5, "퀴즈", "핀테크")]
    df = rules.Screen(LEX).screen(spark.createDataFrame(rows, "id long, title string, body string"))
    out = rules.Screen(LEX).filter_bodies(df)
    assert [r.exclude_reason for r in out.orderBy("id").collect()] == ["무관(제목·본문에서 디지털·AI 근거 없음)", "무관(본문 확인: 디지털·AI 내용 아님)", "스포츠(야구,농구)", None, "홍보성(이벤트)", "무관(제목 노이즈: 퀴즈)"]
    row = rules.ledger(out).first()
    assert row.raw == 6 == row.final + row.excluded
    assert {r.reason: r.n for r in rules.reason_counts(out).collect()} == {"무관": 3, "스포츠": 1, "홍보성": 1}


# -- entities ---------------------------------------------------------------------------------
CFG = {
    "tier1": {"하나": {"menu_id": "hana", "companies": {"은행": ["하나은행"], "카드": ["하나카드"]}, "brands_standalone": ["하나원큐"], "group_keywords": ["하나금융"]}},
    "tier2": {"증권사": {"menu_id": "sec", "subgroups": {"증권": ["미래에셋증권"]}}},
    "overseas": {"menu_id": "overseas", "subgroups": {"미국": ["JP모건"]}, "search_keywords_combined": ["AI"]},
    "search_service_keywords": ["AI", "앱"], "search_service_keywords_lite": ["AI"], "group_service_keywords": ["전략"],
    "topic_section": {"enabled": True, "menu_id": "industry", "search_keywords": ["금융권 AI"]},
}
HINTS = [("은행", ["은행"]), ("증권", ["증권"]), ("카드", ["카드"])]


def test_plan_and_index(spark):
    plan = [tuple(r) for r in entities.search_plan(entities.configured(spark, CFG), entities.word_lists(CFG)).collect()]
    assert [p[0] for p in plan] == ["하나원큐", "하나은행 AI", "하나은행 앱", "하나카드 AI", "하나카드 앱", "하나금융 전략", "미래에셋증권 AI", "JP모건 AI", "금융권 AI"]
    assert plan[1] == ("하나은행 AI", "hana", "하나", "은행") and plan[-1][1:] == ("industry", "업계동향", "industry")
    index = {r.name: (r.menu_id, r.sector) for r in entities.entity_index(entities.configured(spark, CFG), hints=HINTS, aliases={"미래에셋": "미래에셋증권", "없는": "없음"}).collect()}
    assert index["미래에셋"] == ("sec", "증권") and "없는" not in index and index["JP모건"] == ("overseas", "해외")
    assert [r.name for r in entities.company_names(entities.configured(spark, CFG)).collect()] == ["하나은행", "하나카드", "하나원큐", "하나금융", "미래에셋증권", "JP모건"]


def test_dictionary_of_many_names(spark):
    """100,000 names against all of their substrings in texts, found by a join and no array of names."""
    r = random.Random(2)
    names = {"".join(r.choice("abcdefgh") for _ in range(r.randint(1, 9))) for _ in range(100_000)} | {"가나", "가나다", "😀x"}
    texts = [(i, "".join(r.choice("abcdefghij ") for _ in range(r.randint(0, 60)))) for i in range(50)] + [(90, None), (91, ""), (92, "가나다 가나 😀x")]
    got = entities.dictionary_hits(spark.createDataFrame(texts, "id long, text string"), spark.createDataFrame([(n,) for n in names] + [("",)], "name string"))
    want = set()
    for i, t in texts:
        has = {t[a:b] for a in range(len(t)) for b in range(a + 1, a + 10)} & names if t else set()
        want |= {(i, x) for x in has if not any(len(y) > len(x) and x in y for y in has)}
    assert {(x.id, x.name) for x in got.collect()} == want and got.count() == len(want)
    assert "BroadcastNestedLoop" not in got._jdf.queryExecution().toString() and "Python" not in got._jdf.queryExecution().toString()


def test_classify(spark):
    index = entities.entity_index(entities.configured(spark, CFG), hints=HINTS, aliases={"미래에셋": "미래에셋증권"})
    rows = [
        (0, "하나원큐 AI 개편", None, "x", "s", None), (1, "하나금융, 하나카드와 협력", None, "x", "s", None), (2, "소식", "하나은행 생성형 AI", "x", "s", None),
        (3, "소식", None, "kw", "검색", "은행"), (4, "업권 AI", None, "industry", "s", None), (5, "미래에셋 출범", None, "x", "s", None),
    ]
    df = spark.createDataFrame(rows, "id long, title string, body string, menu_id string, subgroup string, sector_hint string")
    out = entities.classify(df, index, ai=["AI"], services=["앱", "AI"], skip=["개편"], brands={"하나원큐": "하나은행"}, hints=HINTS, topic_menu="industry").orderBy("id").collect()
    assert [(r.fin_group, r.company, r.sector, r.dig_ai, r.classify_source) for r in out] == [
        ("hana", "하나은행", "은행", "AI", "title"), ("hana", "하나카드", "카드", "디지털", "title"), ("hana", "하나은행", "은행", "AI", "body"),
        ("kw", "검색", "은행", "디지털", "keyword"), ("etc", "금융권", "기타", "AI", "topic"), ("sec", "미래에셋", "증권", "디지털", "title"),
    ]
    assert out[0].matched_keywords == "하나원큐, AI"


def test_stems(spark):
    stems = lambda t: one(spark, entities.company_stems("t", ["KB국민은행", "기업은행", "토스"]), t=t)
    assert stems("KB국민, JP모건 협력") == ["KB국민"] and stems("기업결제 출시") == [] and stems("토스 기업은행") == ["기업은행", "토스"]


# -- joins against brute force ------------------------------------------------------------------
@pytest.mark.parametrize("t", [0.35, 0.5, 0.9])
def test_token_pairs(spark, t):
    r = random.Random(int(t * 100))
    sets = [(i, sorted(r.sample("abcdefghijklmnop", r.randint(1, 8)))) for i in range(80)]
    want = {(i, j) for i, a in sets for j, b in sets if i < j and len(set(a) & set(b)) / min(len(a), len(b)) >= t - 1e-12}
    assert {(x.a, x.b) for x in token_pairs(spark.createDataFrame(sets, "id long, tokens array<string>"), t).collect()} == want


def test_token_pairs_between(spark):
    r = random.Random(4)
    a, b = ([(i, sorted(r.sample("abcdefghijklmnop", r.randint(1, 8)))) for i in range(40)] for _ in range(2))
    want = {(i, j): len(set(x) & set(y)) for i, x in a for j, y in b if len(set(x) & set(y)) / min(len(x), len(y)) >= 0.5}
    left, right = (spark.createDataFrame(rows, "id long, tokens array<string>") for rows in (a, b))
    assert {(x.a, x.b): x.common for x in token_pairs_between(left, right, 0.5).collect()} == want
    many = spark.createDataFrame([(i, ["a", "b"]) for i in range(50)] + [(99, ["a", "b", "c"]), (100, ["x"])], "id long, tokens array<string>")
    assert {(x.id, x.class_id, x.links) for x in token_links(many, 0.9).collect()} == {(i, 0, 1) for i in range(50)} | {(99, 99, 1), (100, 100, 0)}
    prints = spark.createDataFrame([(1, 7), (2, 7), (3, 6), (4, 0), (5, -1)], "id long, fp long")
    assert {(x.id, x.class_id, x.links) for x in fingerprint_links(prints, 6).collect()} == {(1, 1, 1), (2, 1, 1), (3, 3, 1), (5, 5, 0)}


@pytest.mark.parametrize("d", [0, 1, 3, 6, 10])
def test_near_fingerprints(spark, d):
    r = random.Random(d)
    base = [r.getrandbits(64) - 2**63 for _ in range(12)]
    fps = base + [b ^ sum(1 << k for k in r.sample(range(63), r.randint(1, 9))) for b in base for _ in range(5)] + [0]
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    got = {(x.l, x.r): x.distance for x in near_fingerprints(df, df, d).collect()}
    bits = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count()
    assert got == {(a, b): bits(a, b) for a in set(fps) for b in set(fps) if a and b and bits(a, b) <= d}


def test_similar_titles(spark):
    r = random.Random(5)
    titles = ["".join(r.choice("abcde ") for _ in range(r.randint(3, 12))).strip() or "x" for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(titles)]
    want = {(i, j) for i, a in rows for j, b in rows if i < j and difflib.SequenceMatcher(None, b, a).ratio() >= 0.62}
    first = {t: i for i, t in reversed(rows)}
    want = {(i, j) for i, j in want if titles[i] != titles[j] and first[titles[i]] == i and first[titles[j]] == j}
    assert {(x.a, x.b) for x in similar_titles(spark.createDataFrame(rows + rows, "id long, title string"), 0.62).collect()} == want


def test_components_and_stars(spark):
    r = random.Random(9)
    pairs = [tuple(sorted(r.sample(range(60), 2))) for _ in range(40)]
    rows = spark.createDataFrame([(i, i) for i in range(60)], "id long, seq long")
    edges = spark.createDataFrame(pairs, "a long, b long")
    root = {i: i for i in range(60)}
    for _ in root:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    assert {x.id: x.component for x in components(edges, rows).collect()} == root
    head = {}
    for i in range(60):
        head[i] = next((j for j in range(i) if head[j] == j and (j, i) in set(pairs)), i)
    assert {x.id: x.head for x in stars(rows, edges).collect()} == head


def test_ordered_clusters(spark):
    r = random.Random(3)
    n = 70
    names = [sorted(r.sample("ABC", r.choice([0, 1, 1, 2]))) for _ in range(n)]
    alone = [r.random() < 0.1 for _ in range(n)]
    clash = lambda a, b: a and b and not set(a) & set(b)
    match = {(i, j) for i in range(n) for j in range(i + 1, n) if r.random() < 0.04 and not clash(names[i], names[j])}
    clusters = []
    for j in range(n):
        home = None if alone[j] else next((c for c in clusters if not clash(names[c[0]], names[j]) and any((m, j) in match for m in c)), None)
        clusters.append([j]) if home is None else home.append(j)
    want = {i: c[0] for c in clusters for i in c}
    rows = spark.createDataFrame([(i, i, names[i], alone[i]) for i in range(n)], "id long, seq long, companies array<string>, alone boolean")
    assert {x.id: x.cluster for x in ordered_clusters(rows, spark.createDataFrame(sorted(match), "a long, b long")).collect()} == want


def test_batch_clusters_like_comparing_all(spark):
    """The ordered rule over all pairs of rows, on titles, bodies and words with many copies and companies that conflict."""
    r = random.Random(12)
    names = ["하나은행", "신한은행", "토스"]
    words = ["블록", "송금", "상담", "지점", "카드", "자산", "결제", "인증"]
    titles = [" ".join(r.sample(names, r.choice((0, 1, 1, 2))) + r.sample(words, r.randint(2, 4))) for _ in range(25)]
    bodies = ["".join(r.choice("가나다라마바사 ") for _ in range(400)) for _ in range(8)] + [None, "짧은 본문"]
    rows = [(i, i, r.choice(titles), r.choice(bodies), f"2026-07-{r.randint(1, 3):02}") for i in range(90)]
    f = dedup.features(spark.createDataFrame(rows, "id long, seq long, title string, body string, pub_date string"), names)
    feats = {x.id: x for x in f.collect()}
    clash = lambda a, b: a.companies and b.companies and not set(a.companies) & set(b.companies)

    def match(a, b):
        if clash(a, b):
            return False
        both, common = a.body_ok and b.body_ok, set(a.content) & set(b.content)
        share = len(common) / min(len(a.content), len(b.content)) if min(len(a.content), len(b.content)) >= 2 and len(common) >= 2 else 0
        near = ((a.fp ^ b.fp) & (2**64 - 1)).bit_count() <= 6
        alike = difflib.SequenceMatcher(None, b.norm_title, a.norm_title).ratio() >= 0.62
        return a.norm_title == b.norm_title or (both and (a.body_hash == b.body_hash or near)) or alike or share >= 0.5 or (a.pub_date == b.pub_date and share >= 0.35)

    clusters = []
    for j in range(90):
        home = None if j % 11 == 5 else next((c for c in clusters if not clash(feats[c[0]], feats[j]) and any(match(feats[m], feats[j]) for m in c)), None)
        clusters.append([j]) if home is None else home.append(j)
    got = dedup.batch_clusters(f, roundup=F.col("id") % 11 == 5)
    assert {x.id: x.cluster for x in got.collect()} == {i: c[0] for c in clusters for i in c}


ARTICLE = "id long, seq long, title string, body string, press string, pub_date string, url_hash string, extract_ok int, excluded boolean, exclude_reason string"


def test_dedup(spark):
    names = ["우리은행", "모건스탠리", "하나은행"]
    same = "하나은행 송금 서비스 내용을 설명하는 본문 문장입니다 " * 20
    rows = [
        (1, 1, "우리은행 여신 AX 본격화 기업 AI", None, "p", "2026-07-26", "u1", 0, False, None),
        (2, 2, "모건스탠리 AI 도입 기업 이익률", None, "p", "2026-07-26", "u2", 0, False, None),
        (3, 3, "하나은행 블록체인 송금 시작", same, "p", "2026-07-26", "u3", 1, False, None),
        (4, 4, "전혀 다른 제목의 기사 하나", same, "q", "2026-07-27", "u4", 1, False, None),
        (5, 5, "이미 본 기사", None, "p", "2026-07-26", "old", 0, False, None),
        (6, 6, "퀴즈", None, "p", "2026-07-26", "u6", 0, True, "무관(퀴즈)"),
        (7, 7, "가", "짧은 본문", "p", "2026-07-26", "u7", 1, False, None),
        (8, 8, "나", "짧은 본문", "p", "2026-07-26", "u8", 1, False, None),
    ]
    past = [(100, 1, "예전 기사", None, "p", "2026-07-25", "old", 0, False, None)]
    out = {r.id: r for r in dedup.dedup(spark.createDataFrame(rows, ARTICLE), spark.createDataFrame(past, ARTICLE), names=names).collect()}
    assert len(out) == 8
    assert {i: r.dup_of for i, r in out.items() if r.dup_of is not None} == {4: 3, 5: 100}
    assert out[4].exclude_reason.startswith("중복(") and out[5].exclude_reason.startswith("기열람(") and out[6].exclude_reason == "무관(퀴즈)"
    assert [i for i, r in out.items() if not r.excluded] == [1, 2, 3, 7, 8] or sorted(i for i, r in out.items() if not r.excluded) == [1, 2, 3, 7, 8]


def test_summary_dedup(spark):
    rows = [(1, 1, "KB국민, 송금 출시", "- 블록체인 송금 서비스 키넥시스 활용\n- 기업 고객 대상"), (2, 2, "KB국민은행 혁신", "- 블록체인 송금 서비스 키넥시스 적용\n- 은행 최초"), (3, 3, "하나은행", "- 블록체인 송금 서비스 키넥시스 활용")]
    df = spark.createDataFrame(rows, "id long, seq long, title string, summary string").withColumns({"pub_date": F.lit("2026-07-26"), "press": F.lit("p"), "body": F.lit(""), "extract_ok": F.lit(1)})
    assert {x.id: x.head for x in dedup.summary_stars(df, ["KB국민은행", "하나은행"]).collect()} == {1: 1, 2: 1, 3: 3}
    assert [(x.id, x.ref) for x in dedup.summaries_seen(df.where("id = 2"), df.where("id != 2"), ["KB국민은행", "하나은행"]).collect()] == [(2, 1)]


# -- history, sources, streams ---------------------------------------------------------------------
def test_window(spark):
    now = datetime(2026, 7, 26, 12)
    start = lambda last: one(spark, history.window_start(F.col("l").cast("timestamp"), F.lit(now)), l=last)
    assert start(None) == now - timedelta(hours=24) and start(now - timedelta(hours=1)) == now - timedelta(hours=3)
    assert start(now - timedelta(hours=36)) == now - timedelta(hours=36, minutes=20) and start(now - timedelta(days=5)) == now - timedelta(hours=72)


def test_search_source(spark):
    begin, end = datetime(2026, 7, 1, tzinfo=timezone.utc), datetime(2026, 7, 2, tzinfo=timezone.utc)

    def fetch(query, start, count):
        if query == "broken":
            raise ValueError("no")
        day = {1: "01 Jul", 3: "30 Jun", 5: "30 Jun", 7: "01 Jul"}[start]
        return [{"title": f"<b>{query}</b> {start}", "originallink": f"http://x/{start}?utm_a=1", "link": "", "pubDate": f"Wed, {day} 2026 10:00:00 +0000"}, {"title": "undated", "pubDate": ""}]

    rows = search.search_rows(spark, [("q", "m", "s", None), ("broken", "m", "s", None), ("q2", "m", "s", None)], fetch, begin, end, count=2, last=9)
    got = search.collected(rows).collect()
    assert [(r.title, r.search_keyword) for r in got] == [("q 1", "q")]  # q2 finds the same address
    assert {r.search_keyword: (r.status, r.found) for r in search.health(rows).collect()} == {"q": ("ok", 1), "q2": ("ok", 1), "broken": ("failed", 0)}
    with pytest.raises(search.RateLimited):
        search.with_retries(lambda *a: (_ for _ in ()).throw(search.RateLimited()), "q", 1, 2, wait=lambda s: None)
    press = search.press_rows(spark, {"a": ("하나", "hana", lambda b: [("t ", b, "u", None, None)]), "b": ("KB", "kb", lambda b: 1 / 0)}, begin.replace(tzinfo=None)).collect()
    assert sorted((r.kind, r.adapter, r.status) for r in press if r.kind == "health") == [("health", "a", "ok (1건)"), ("health", "b", "실패: division by zero")]


def test_store(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    store.start_run(1, "2026-07-26T10:00", "a", "b")
    store.append("articles", spark.createDataFrame([(1, 1, "t"), (2, 1, "u")], "id long, run_id long, title string"))
    store.deliver(1, spark.createDataFrame([(1,)], "id long"), "2026-07-26T11:00")
    store.start_run(2, "2026-07-26T12:00", "a", "b")
    assert {r.run_id: r.status for r in store.runs().collect()} == {1: "success", 2: "running"}
    assert [r.id for r in store.history().collect()] == [1]
    store.append("articles", spark.createDataFrame([(3, 2, "a"), (4, 3, "z")], "id long, run_id long, title string"))
    assert sorted(r.id for r in store.as_if_delivered(spark.createDataFrame([(9, 9, "n")], "id long, run_id long, title string")).collect()) == [1, 9]
    store.retain("articles", "title", "u")
    assert sorted(r.id for r in store.read("articles").collect()) == [2, 4]
    store.update("articles", store.read("articles").where("id = 4").withColumn("title", F.lit("x")))
    assert {r.id: r.title for r in store.read("articles").collect()} == {2: "u", 4: "x"}
    assert store.drop("articles", spark.createDataFrame([(2,)], "id long")) == 1
    (tmp_path / "c.yaml").write_text("a: {b: [1, 2]}")
    assert load_config(f"{tmp_path}/c.yaml") == {"a": {"b": [1, 2]}}
    publish(f"{tmp_path}/a.html", reports.render("t", [], [], [], {"raw": 1}))
    write_csv(f"{tmp_path}/a.csv", ["x"], [["ü"]])
    assert (tmp_path / "a.csv").read_bytes().startswith(b"\xef\xbb\xbf") and "raw: 1" in (tmp_path / "a.html").read_text()


def test_stream_and_views(spark, tmp_path):
    src = f"{tmp_path}/in"
    spark.createDataFrame([("a", datetime(2026, 7, 1)), ("a", datetime(2026, 7, 1, 1)), ("b", datetime(2026, 7, 1, 2))], "k string, ts timestamp").write.parquet(src)
    seen = []
    s = incremental.once_each(incremental.source(spark, src, "k string, ts timestamp"), "ts", "k")
    incremental.run_available(s, f"{tmp_path}/cp", lambda df, b: seen.extend(r.k for r in df.collect()))
    assert sorted(seen) == ["a", "b"]
    rows = spark.createDataFrame([(1, 1, "신한 AI 카드 출시"), (2, 2, "신한 AI 카드 공개"), (3, 3, "다른 이야기")], "id long, seq long, title string")
    assert {x.id: x.head for x in reports.display_groups(rows).collect()} == {1: 1, 2: 1, 3: 3}
    assert one(spark, reports.neutral("w", [("검토", "무관")]), w="검토 에이전트") == "무관 에이전트"
    counts = history.tab_counts(spark.createDataFrame([("hana", "은행"), ("policy", "은행")], "g string, s string"), "g", "s", folded=("policy",))
    assert {(r.tab, r.sector): r.n for r in counts.collect()}[("etc", None)] == 1


def test_entry_without_llm():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 40 and json.dumps(list(e.queries()))


# -- a whole run -----------------------------------------------------------------------------------
def test_review_and_summaries(spark):
    from siftmill.operators import review as R

    good = "- 신한은행 디지털 자산 서비스 출시\n- 기업 고객 대상 송금 지원"
    body = "신한은행 디지털 자산 서비스 출시 기업 고객 대상 송금 지원 " * 10
    calls, waits = [], []

    def call(model, title, text):
        calls.append(model)
        if model == "a":
            raise R.DailyLimit
        if len(calls) < 4:
            raise R.MinuteLimit(3 if len(calls) == 2 else None)
        return good

    assert R.answer(call, ["a", "b"], "t", body, waits.append) == (good, None, "b") and waits == [3, 4.0]
    assert R.answer(lambda *a: (_ for _ in ()).throw(R.MinuteLimit(1)), ["a"], "t", body, waits.append)[1] == "분당한도"
    assert R.answer(lambda *a: (_ for _ in ()).throw(R.DailyLimit()), ["a"], "t", body)[1] == "레이트리밋(일일)"

    def said(model, title, text):
        return {"good": good, "bad form": "x", "made up": "- 전혀 없는 이야기를 지어낸 요약\n- 원문과 무관한 내용만 나열"}[title]

    rows = [(1, "good", body, False), (2, "good", None, False), (3, "good", "x", False), (4, "bad form", body, False), (5, "made up", body, False), (6, "good", body, True)]
    out = R.summarised(spark.createDataFrame(rows, "id long, title string, body string, excluded boolean"), said)
    got = {r.id: (r.summary, r.summary_fail_reason, r.summary_ok) for r in out.collect()}
    assert got[1] == (good, None, True) and got[6] == (None, None, False)
    assert [got[k][1] for k in (2, 3, 5)] == ["본문 없음", "본문 부족(1자)", "환각 의심"] and got[4][1].startswith("형식 검증 실패: 줄 수 부족")


def test_whole_run(spark, tmp_path):
    from siftmill.plans.run import Job, run

    body = "하나은행 생성형 AI 상담 서비스를 내놓는 계획을 발표 하나은행 고객 상담 개선 기대. " * 8
    rows = [
        (1, 1, "하나은행 AI 상담 시작", body, "p", "2026-07-26", "http://a/1", "", "hana", "s", None, "q"),
        (2, 2, "하나은행 AI 상담 시작", body, "q", "2026-07-26", "http://a/2", "", "hana", "s", None, "q"),
        (3, 3, "하나은행 퀴즈", body, "p", "2026-07-26", "http://a/3", "", "hana", "s", None, "q"),
        (4, 4, "하나은행 AI 상담 시작", body, "p", "2026-07-26", "http://a/1?utm_x=1", "", "hana", "s", None, "q"),
        (5, 5, "신한은행 디지털 지점 개점 소식 전달", "신한은행 디지털 지점 " * 40, "p", "2026-07-26", "http://a/5", "", "shinhan", "s", None, "q"),
    ]
    df = spark.createDataFrame(rows, "id long, seq long, title string, body string, press string, pub_date string, original_url string, naver_url string, menu_id string, subgroup string, sector_hint string, search_keyword string")
    index = entities.entity_index(entities.configured(spark, CFG), hints=HINTS)
    store = Store(spark, f"file://{tmp_path}/s")
    judge = lambda t, b: "NO" if "신한" in t else "YES"
    said = lambda m, t, b: "- 하나은행 생성형 AI 상담 서비스 발표\n- 하나은행 고객 상담 개선 기대"
    counts = run(spark, df, Job(LEX, index, names=["하나은행", "신한은행"], judge=judge, summarize=said), store, 1, "2026-07-26T10:00", f"{tmp_path}/p.html")
    assert counts == {"raw": 4, "final": 1, "excluded": 3, "duplicates": 1, "seen": 0, "screened": 2, "extract_fail": 0, "summary_fail": 0, "review_no": 1}
    assert {r.run_id: r.status for r in store.runs().collect()} == {1: "success"}
    [row] = store.history().collect()
    page = (tmp_path / "p.html").read_text()
    assert '<option value="hana">hana 1</option>' in page and "<summary>dup 1</summary>" in page and "<h2>1</h2>" in page
    assert "2026-07-26 (일) (1)" in reports.render_list("t", reports.listed(store.history()).collect())
    assert (row.id, row.company, row.summary.count("\n")) == (1, "하나은행", 1) and "하나은행 AI 상담 시작" in (tmp_path / "p.html").read_text()
    # A second run: an address, a title and a summary that were delivered, and something new.
    again = [
        (11, 1, "다른 제목의 하나은행 AI", body, "p", "2026-07-27", "http://a/1?utm_source=y", "", "hana", "s", None, "q"),
        (12, 2, "하나은행 AI 상담 시작", "", "q", "2026-07-27", "http://b/2", "", "hana", "s", None, "q"),
        (13, 3, "하나은행 디지털 고객 응대 개편", "하나은행 지점 고객 응대를 새로 고친다는 소식 " * 20, "p", "2026-07-27", "http://b/3", "", "hana", "s", None, "q"),
        (14, 4, "신한은행 디지털 지점 개점", "신한은행 디지털 지점 개점 소식을 전하는 본문 " * 20, "p", "2026-07-27", "http://b/4", "", "shinhan", "s", None, "q"),
    ]
    told = lambda m, t, b: said(m, t, b) if "하나" in t else "- 신한은행 디지털 지점 개점 소식 전달\n- 신한은행 디지털 지점 본문 소식"
    loose = lambda m, t, b: "- 하나은행 고객 응대 소식 새로 고친\n- 하나은행 고객 지점 응대 소식 새로" if "응대" in t else told(m, t, b)
    job = Job(LEX, index, names=["하나은행", "신한은행"], judge=lambda t, b: "YES", summarize=loose)
    counts = run(spark, spark.createDataFrame(again, df.schema), job, store, 2, "2026-07-27T10:00")
    out = {r.id: r.exclude_reason for r in store.read("excluded").where("run_id = 2").collect()}
    assert out[11].startswith("기열람(") and out[12].startswith("기열람(") and counts["seen"] >= 2 and counts["raw"] == 4
    assert sorted(r.id for r in store.history().where("run_id = 2").collect()) == sorted({13, 14} - set(out))
    assert {r.url_hash: r.told for r in store.read("summaries").where("run_id = 1").collect()}  # kept for a run that starts over
    cached = Job(LEX, index, names=["하나은행", "신한은행"], judge=judge, summarize=lambda m, t, b: 1 / 0)
    from siftmill.plans.run import with_summaries

    again = with_summaries(spark.createDataFrame([(1, "t", body, False, store.history().where("id = 1").first().url_hash)], "id long, title string, body string, excluded boolean, url_hash string"), cached, store, 3).collect()
    assert again[0].summary_ok and again[0].summary == row.summary
    first, second = (store.runs().where(f"run_id = {k}").first() for k in (1, 2))
    assert second.search_start == "2026-07-26T09:40:00" and first.search_start == "2026-07-25T10:00:00"


def test_dictionary_looks_up_a_piece_once(spark, monkeypatch):
    """Texts are cut where no name can be; a word that many texts have is looked up once, and a name within another piece's longer name goes."""
    asked = []
    within = entities._names_within
    monkeypatch.setattr(entities, "_names_within", lambda pieces, *a: (asked.append(pieces), within(pieces, *a))[1])
    texts = [(i, "con-content, icon [x] 가나" if i % 2 else "con con\nicon") for i in range(40)]
    got = entities.dictionary_hits(spark.createDataFrame(texts, "id long, text string"), spark.createDataFrame([("con",), ("content",), ("가나",), ("]",)], "name string"))
    assert {(x.id, x.name) for x in got.collect()} == {(i, n) for i in range(40) for n in (("content", "]", "가나") if i % 2 else ("con",))}
    assert sorted(x.piece for x in asked[0].collect()) == sorted(["con", "content", "]", "가나"])  # no name has an i, which is cut off

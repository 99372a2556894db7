"""Reports and policies built in code, in the stored shape."""

from __future__ import annotations

import copy
import json

from dayfolio import config, schemas

DATE = "2088-03-09"
RUN = {"modelId": "model-1", "modelDisplayName": "Model 1", "reasoningEffort": "high",
       "modelSelectionVerified": True, "runId": "run-2088-03-09-tests"}
POLICY = {
    "schemaVersion": "1.1", "requiredModelId": RUN["modelId"], "requiredModelDisplayName": RUN["modelDisplayName"],
    "requiredReasoningEffort": "high", "requireExplicitModelSelection": True, "qualificationStatus": "not_benchmarked",
    "qualificationRequiredForPublication": False, "historicalRunExceptions": [], "verificationScope": "Metadata.",
    "publicationRule": "Complete sets only.", "lastReviewed": DATE,
}
RUBRIC = "Rubric 3.0"


TOPICS = ("泡の膜", "鎖の輪", "霧の粒", "波の縁", "渦の芯", "殻の層", "枝の節", "縞の幅", "孔の壁", "環の列", "塵の帯")
TOOLS = ("格子の計算", "束縛の方程式", "散乱の実験", "対称性の議論")


def paper(slug: str, i: int) -> dict:
    """The i-th best paper of a category: total scores fall, the first ten are read in full."""
    place = config.CATEGORIES.index(slug)
    number, full = f"2601.{20001 + 97 * i + 3000 * place:05d}", i < 10
    topic, tool = TOPICS[i % len(TOPICS)] + "一二三"[place], TOOLS[(i + place) % len(TOOLS)]
    scores = {"broadImpact": 22 - i, "categoryImpact": 21, "originality": 19, "technicalStrength": 18 if full else 16}
    pages = [f"https://arxiv.org/abs/{number}v1", f"https://arxiv.org/pdf/{number}v1"]
    record = {
        "rank": i + 1, "arxivId": number, "arxivVersion": "v1", "submissionType": "new", "url": pages[0].removesuffix("v1"),
        "title": f"On problem {i} of {slug}", "titleJa": f"{topic}をめぐる{tool}", "authors": [f"Kim {slug} {i}", "Lee Mora"], "primaryCategory": slug,
        "paperType": "理論", "scores": scores, "totalScore": sum(scores.values()),
        "scoreReasons": {
            "broadImpact": f"{topic}の見方は隣り合う分野の測定にもそのまま使える。", "categoryImpact": f"長く残っていた{topic}の問いへはっきりした答えを返す。",
            "originality": f"{tool}を{topic}へ当てる例はこれまで見当たらない。", "technicalStrength": f"{topic}への{tool}は誤差の見積もりまで済んでいる。"},
        "abstractLines": [f"{topic}がなぜ崩れないのかを問う。", f"{tool}を小さな系から大きな系へ進める。", f"{topic}の寿命と大きさの間に簡単な関係がある。"],
        "curiosity": f"{topic}はいつまで形を保つのか。", "concept": f"{topic}の言葉で{tool}を書き直す。", "conclusion": f"{topic}の寿命は大きさだけで決まる。",
        "assessment": f"{topic}の結論は明快だが温度の高い場合は含まれない。", "evaluationBasis": config.FULL_TEXT_BASIS if full else config.ABSTRACT_BASIS,
        "fullTextEvaluated": full, "sourceUrls": pages if full else pages[:1],
    }
    if full:
        record["fullTextReviewStatus"] = f"{topic}の章と末尾の補遺を通して読んだ。"
    return record


def report(slug: str, count: int = 13, date: str = DATE) -> dict:
    """A category's report, its counts taken from its papers and its texts named after their fields."""
    place, papers = config.CATEGORIES.index(slug), [paper(slug, i) for i in range(count)]
    read, excluded = sum(p["fullTextEvaluated"] for p in papers), 7 - place
    agreed = {name: f"{RUBRIC}, {name} as agreed" for name in schemas.AUDIT_TEXT_KEYS}
    counted = dict(zip(schemas.COUNT_KEYS, (count, excluded, count), strict=True))
    seen = {"listingUrl": f"https://arxiv.org/list/{slug}/new", "announcementDate": date, "sourceCounts": counted,
            "fullTextEvaluatedCount": read, "generatedAtJst": f"{date}T06:4{place}:10+09:00"}
    totals = {"totalNew": count, "evaluatedCount": count, "crosslistsExcluded": excluded, "fullTextEvaluatedCount": read}
    return {"schemaVersion": config.CURRENT_SCHEMA, "reportDate": date, "slug": slug, "label": f"{slug} today", **totals,
            "evaluationRun": dict(RUN), "audit": agreed | seen, "papers": papers}


def report_set(count: int = 13, date: str = DATE) -> list[dict]:
    return [report(slug, count, date) for slug in config.CATEGORIES]


def frame(spark, records: list[dict], schema: str = schemas.REPORT):
    """Reads dictionaries through JSON with an explicit schema."""
    texts = spark.createDataFrame([(json.dumps(r, ensure_ascii=False),) for r in records], "value string")
    from pyspark.sql import functions as F
    return texts.select(F.from_json("value", schema).alias("r")).select("r.*")


def changed(records: list[dict], edit) -> list[dict]:
    fresh = copy.deepcopy(records)
    edit(fresh)
    return fresh

"""Knowledge base, taxonomy classification, answers and judgements: prompts around one model call."""

from __future__ import annotations

import json
import warnings
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clausewise.functions.arrays import chunk, merge_near_duplicates, prompt_sample
from clausewise.functions.replies import json_body, parse_answer, parse_issues, parse_judgements

from .clusters import nearest
from .joins import search_reviews
from .ledger import Ledger
from .ordered_merge import merge_lists
from .providers import call
from .taxonomy import COARSE, coarse_category, fine_rows, valid_key


def bullets(items: Column, letters: int = 400) -> Column:
    return F.array_join(F.transform(items, lambda x: F.concat(F.lit("- "), F.substring(x, 1, letters))), "\n")


def numbered(items: Column, first: Column | int = 1, letters: int | None = 400) -> Column:
    """``letters=None`` keeps every item whole."""
    return F.array_join(F.transform(items, lambda x, i: F.concat(
        (i + first).cast("string"), F.lit(". "), x if letters is None else F.substring(x, 1, letters))), "\n")


def failed_calls(replies: DataFrame) -> DataFrame:
    """One row: calls, and those that failed after all attempts; whoever drops failures should tell."""
    return replies.agg(F.count("*").alias("calls"), F.count("error").alias("failed"))


def without_failures(replies: DataFrame, what: str) -> DataFrame:
    """The rows whose calls went well; how many did not is warned of."""
    told = failed_calls(replies).first()
    if told["failed"]:
        warnings.warn(f"{told['failed']} of {told['calls']} calls failed; their {what} are left out and asked for again next time", stacklevel=3)
    return replies.where("error is null")


def knowledge_base(blocks: DataFrame, ledger: Ledger, threshold: float = 0.45, size: int = 60, limit: int = 0) -> DataFrame:
    """cluster_id, issues (by importance, then by first appearance), clause_count (after merging
    near-duplicates).

    Clauses are merged and cut into chunks, each chunk is one prompt, the issues of all chunks are
    merged again and averaged by their exact text.  A block whose replies name no issue stays, with none;
    one of which a call failed is left out and warned of; one without clauses is no block.
    """
    rows = blocks.where(F.size("clauses") > 0)
    rows = rows.orderBy("cluster_id").limit(limit) if limit else rows
    merged = merge_lists(rows, "cluster_id", "clauses", threshold)
    prompts = merged.select("cluster_id", F.size("clauses").alias("clause_count"), F.posexplode(chunk(F.col("clauses"), size)).alias("part", "chunk")).select(
        "cluster_id", "clause_count", "part",
        F.concat(F.lit('Name the issues in these clauses as JSON {"issues":[{"issue":"..","importance":0-10}]}.\n'), bullets(F.col("chunk"))).alias("prompt"))
    replies = ledger.ask(prompts)
    whole = replies.groupBy("cluster_id").agg(
        F.first("clause_count").alias("clause_count"), F.count("error").alias("failed"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("part", parse_issues(F.col("reply")).alias("issues")))), lambda x: x["issues"])).alias("all"))
    left_out = whole.where("failed > 0").count()
    if left_out:
        warnings.warn(f"{left_out} blocks are left out: a call failed", stacklevel=2)
    kept = merge_near_duplicates(F.transform("all", lambda x: x["issue"]), threshold)

    def scored(issue, at):
        own = F.filter("all", lambda x: x["issue"] == issue)
        mean = F.aggregate(own, F.lit(0).cast("long"), lambda s, x: s + x["importance"]) / F.size(own)
        return F.struct((-F.bround(mean, 0)).cast("int").alias("o"), at.alias("pos"), issue.alias("issue"), F.bround(mean, 0).cast("int").alias("importance"))

    return whole.where("failed = 0").withColumn("kept", kept).select(
        "cluster_id", F.transform(F.array_sort(F.transform("kept", scored)), lambda x: F.struct(x["issue"], x["importance"])).alias("issues"), "clause_count")


def consolidate(issues: list[dict], provider: Callable[[str], str]) -> list[dict]:
    """One more pass over the issues of a block; one issue or a failure gives the input back."""
    if len(issues) <= 1:
        return issues
    try:
        reply = call(provider, "Merge paraphrases, keep the largest importance, same JSON:\n" + json.dumps({"issues": issues}, ensure_ascii=False), 1)
        found = json.loads(reply[reply.index("{") : reply.rindex("}") + 1])["issues"]
        return [{"issue": str(i["issue"]).strip(), "importance": max(0, min(10, round(float(i["importance"]))))} for i in found] or issues
    except Exception:
        return issues


def classify(blocks: DataFrame, ledger: Ledger, fine: bool = False, cache: DataFrame | None = None, report_only: bool = False,
             fix_dash: bool = False, limit: int = 0) -> DataFrame:
    """cluster_id, category (or subcategory_key), block_name, size of blocks that the cache lacks;
    a reply that cannot be read, and a block without clauses (no call), is 'other' without a name; a
    failed call leaves the block out and is warned of."""
    some = blocks.orderBy("cluster_id").limit(limit) if limit else blocks
    todo = some if cache is None else some.join(cache.select("cluster_id"), "cluster_id", "left_anti")
    if report_only:
        todo = todo.limit(0)
    keys = [r[3] for r in fine_rows()] if fine else [k for k, _ in COARSE]
    ask = f"Choose one of {', '.join(keys)} and a short name, as JSON {{\"category\":\"..\",\"block_name\":\"..\"}}.\n"
    prompts = todo.select("cluster_id", "size", F.when(F.size("clauses") > 0, F.concat(F.lit(ask), bullets(prompt_sample(F.col("clauses"))))).alias("prompt"))
    got = without_failures(ledger.ask(prompts), "blocks").withColumn(
        "j", F.from_json(json_body(F.col("reply")), "category string, subcategory string, block_name string"))
    said = F.coalesce("j.category", "j.subcategory", F.lit(""))
    name = F.coalesce(F.col("j.block_name"), F.lit(""))
    if fine:
        return got.select("cluster_id", valid_key(F.trim(said), keys).alias("subcategory_key"), name.alias("block_name"), "size")
    return got.select("cluster_id", coarse_category(said, fix_dash=fix_dash).alias("category"), name.alias("block_name"), "size")


def judge(reviews: DataFrame, ledger: Ledger, size: int = 5) -> DataFrame:
    """seq (dense from 1), text, location -> location, judgement, action of the negative ones."""
    batch = F.floor((F.col("seq") - 1) / size)
    grouped = reviews.groupBy(batch.alias("batch")).agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda x: x["text"]).alias("texts"))
    prompts = grouped.select("batch", F.concat(F.lit("Judge:\n"), numbered(F.col("texts"), F.col("batch") * size + 1, None)).alias("prompt"))
    got = without_failures(ledger.ask(prompts), "reviews").select(F.explode(parse_judgements(F.col("reply"))).alias("j")).select("j.*")
    return judgement_rows(got, reviews)


def judgement_rows(got: DataFrame, reviews: DataFrame) -> DataFrame:
    """Locations by the 1-based index; an index out of range is 'Review n'."""
    return got.join(reviews.select(F.col("seq").alias("index"), "location"), "index", "left").select(
        F.coalesce("location", F.concat(F.lit("Review "), F.col("index").cast("string"))).alias("location_name"),
        F.coalesce("reason", F.lit("")).alias("judgement"),
        F.array_join(F.coalesce("action_items", F.array().cast("array<string>")), "; ").alias("action"))


def answer_prompt(query: str, rows: list[dict], letters: int = 400) -> str:
    """The question with its evidence: the titles of the categories, then for each row its place, its score
    (or rating) and the first ``letters`` letters of its text."""
    titles = "\n".join(f"- {title}" for _, title in COARSE)
    said = "\n\n".join(
        f"[{i}] place: {r.get('place_name') or r.get('place') or ''} | score: {float(r['score'] if r.get('score') is not None else r.get('rating') or 0):.2f}\n"
        f"\"{(r.get('clause_text') or r.get('text') or '')[:letters]}\"" for i, r in enumerate(rows, 1))
    return ("Answer the question from the clauses alone, as JSON {\"summary\":\"..\",\"actions\":[\"..\"]}; issues belong to these categories:\n"
            f"{titles}\n\nClauses:\n{said}\n\nQuestion: {query}")


class Engine:
    """Questions over embedded clauses or over reviews by keyword."""

    def __init__(self, clauses: DataFrame, embed, provider: Callable[[str], str], places: DataFrame | None = None):
        self.clauses, self.embed, self.provider, self.places = clauses, embed, provider, places
        self.width: int | None = None

    def ask(self, query: str, max_clauses: int = 15) -> dict:
        if not query.strip():
            return {"summary": "", "actions": [], "source_clauses": []}
        asked = self.embed.encode([query])[0]
        if self.width is None:
            first = self.clauses.select(F.size("embedding").alias("n")).first()
            self.width = first["n"] if first else len(asked)
        if len(asked) != self.width:
            raise ValueError(f"the question has {len(asked)} dimensions and the clauses {self.width}; use the model that embedded them")
        found = nearest(self.clauses, asked, max_clauses).select("clause_text", "place_name", "score", "similarity").collect()
        return self._answer(query, [r.asDict() for r in found], "source_clauses")

    def ask_reviews(self, query: str, max_reviews: int = 15) -> dict:
        found, place = search_reviews(query, self.clauses, self.places, max_reviews)
        return self._answer(query, [r.asDict() for r in found.collect()], "source_reviews") | {"location": place}

    def _answer(self, query: str, rows: list[dict], name: str) -> dict:
        if not rows:
            return {"summary": "", "actions": [], name: []}
        prompt = answer_prompt(query, rows)
        spark = self.clauses.sparkSession
        reply = spark.createDataFrame([(call(self.provider, prompt),)], "raw string").select(parse_answer(F.col("raw")).alias("a")).first()["a"]
        return {"summary": reply["summary"], "actions": list(reply["actions"]), name: rows}

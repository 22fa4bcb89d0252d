"""Column functions of the labelling step: the prompt, keyword answers, reading an answer, its cost."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import bind, words

# Fixed values of the triage task.
LABELS = ("bug", "billing", "other")
PROMPT_HEAD = 'You triage customer-support tickets.\nAnswer ONLY with JSON: {"label": "bug" | "billing" | "other"}.\nTicket: '
ANSWER_TOKENS = 8
PRICE_PER_1K_TOKENS = 0.002
# Keyword pattern and answer, tried in this order; the last answer is for texts no pattern matches.
TRIAGE_RULES = (
    ("xuất", 'Sure! Here is the label: {"label": "export"}'),
    ("crash|lỗi|sso|đăng nhập|chatbot", '{"label": "bug"}'),
    ("tiền|hoá đơn|thanh toán|gói|vat", '{"label": "billing"}'),
)
TRIAGE_DEFAULT = '{"label": "other"}'


def prompt(text: Column, head: str = PROMPT_HEAD) -> Column:
    return F.concat(F.lit(head), text)


def keyword_answer(text: Column, rules: Sequence[tuple[str, str]] = TRIAGE_RULES, default: str = TRIAGE_DEFAULT) -> Column:
    """The answer of the first rule whose pattern occurs in the lower-cased text."""
    lowered = F.lower(text)
    answers = [F.when(lowered.rlike(pattern), F.lit(answer)) for pattern, answer in rules]
    return F.when(text.isNotNull(), F.coalesce(*answers, F.lit(default)))


def parse_label(answer: Column, labels: Sequence[str] = LABELS) -> Column:
    """The `label` of the JSON object inside an answer; null unless it is one of `labels`."""
    found = F.regexp_extract(answer, r"(?s)\{.*\}", 0)
    # The parser overlooks text after an object, but not inside an array.
    array = F.try_parse_json(F.concat(F.lit("["), found, F.lit("]")))

    def label(objects: Column) -> Column:
        only = F.try_variant_get(objects, "$[1]", "variant").isNull()
        value = F.try_variant_get(objects, "$[0].label", "string")
        return F.when(only & value.isin(*labels), value)

    return bind(array, label)


def token_estimate(text: Column) -> Column:
    """Words of the text sent, plus a fixed allowance for the answer."""
    return (F.size(words(text)) + ANSWER_TOKENS).cast("bigint")

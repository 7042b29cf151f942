"""Problem 6: question-answer rows that are unusable as training pairs.

Each answer and thinking text gets at most one defect, the first of: empty (answer only), copy, refusal,
language, truncated. Copies are found by compressing the text with its question as zstandard dictionary:
what costs next to nothing says nothing beyond the question. Languages are told by scripts and
dictionaries of function words, refusals by dictionaries of refusing phrases outside of quotations,
truncation by the terminal-context model of problem 5, fitted as there.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, table
from .textform import canonical
from .truncation import truncated, values

#: Bytes that a copy may cost per byte of its length besides the frame, and its length against the question's.
COPY_COST, COPY_LENGTH = 0.34, 0.6
#: Of a copy's 3-character strings this share is in the question.
COPY_COVER = 0.8
#: Characters besides the refusal that a refusing text may have.
REFUSAL_REST = 60

_TAG = re.compile(r"</?[A-Za-z_][\w-]*\s*/?>")

# Texts that stand for no answer.
_PLACEHOLDERS = frozenset("n/a na null none nil nan undefined tbd todo empty blank 空欄 なし 無し 無回答 未回答 未記入 未入力 該当なし 回答なし 省略".split())

# Function words by language (Latin scripts).
_WORDS = {
    "en": "the of and to in is was were that with for by on at from this it as are be an did what which who how why when where about says said more than",
    "es": "el la los las de del que y en un una por con para se es son lo su al como más nadie quién cada año según eso sigue siendo este esta",
    "fr": "le la les des du de et en un une est sont que qui dans pour par sur avec ce cette il elle au aux plus pas nous vous",
    "de": "der die das und ist sind ein eine einer den dem des mit von zu im auf für nicht auch wird werden nach bei aus sich",
    "pt": "o a os as de do da dos das e em um uma que para por com não se é são no na mais ao como seu sua ainda",
    "it": "il lo la gli le di del della che e in un una per con non si è sono da al alla più come questo questa",
}
# Fixed value: function words of Chinese whose characters Japanese has, too, but rarely writes.
_CHINESE_WORDS = "的了很都也"
_REQUESTS = {
    "en": r"英語|英文|\bin english\b",
    "ja": r"日本語|和文|\bin japanese\b",
    "zh": r"中国語|中文|\bin chinese\b",
    "ko": r"韓国語|ハングル|\bin korean\b",
    "es": r"スペイン語|\bin spanish\b",
    "fr": r"フランス語|\bin french\b",
    "de": r"ドイツ語|\bin german\b",
    "pt": r"ポルトガル語|\bin portuguese\b",
    "it": r"イタリア語|\bin italian\b",
}

# Phrases by which a text declines. The expressions are brought to the one form, as the texts are.
_REFUSALS = re.compile(
    canonical(
    r"(?:答え|応え|応じ|回答|お?手伝い|提供|対応|協力|サポート|判断|説明|案内|お伝え|支援)[^。.!?「」]{0,12}?(?:できません|できかねます|できない|いたしかねます|致しかねます|しかねます|られません|られない|られん|ませんので|控えさせて|控えます|お断り|立場にございません|立場にありません|立場ではありません)"
    r"|(?:控えさせて(?:いただき|頂き)|お断りいたし|お断りし|ご遠慮(?:させて|いたし))"
    r"|\b(?:i|we)(?:'m| am|'re| are)? (?:(?:really |very )?(?:sorry|afraid)[, ]+(?:but )?(?:i|we) )?(?:cannot|can't|can not|won't|will not|unable to|not able to|not allowed to|must decline|have to decline|decline to|refuse to)\b[^.!?]{0,40}?\b(?:answer|help|assist|provide|respond|reply|comply|discuss|share|support|fulfil|fulfill|do that|with that|with this)\b"
    r"|\bas an? (?:ai|language model)\b[^.!?]{0,40}\b(?:cannot|can't|unable|not able|won't)\b"
    ),
    re.I,
)
_QUOTED = re.compile(r"「[^」]*」|『[^』]*』|“[^”]*”|\"[^\"]*\"")
_POLITE_REST = re.compile(canonical(r"申し訳(?:ありません|ございません)が?|すみません(?:が)?|恐れ入りますが|残念ながら|(?:AI|言語モデル)としては|[^。]{0,40}については|専門の窓口に[^。]*|別の質問を[^。]*|ご了承[^。]*|(?:i'm )?sorry|unfortunately|please[^.!?]*|as an? [^,.]*"), re.I)
_LATIN_WORD = re.compile(r"[A-Za-zÀ-ÖØ-öø-ɏ']+")


@functools.cache
def _word_sets() -> dict[str, frozenset[str]]:
    return {k: frozenset(v.split()) for k, v in _WORDS.items()}


def _encodes(c: str, codec: str) -> bool:
    try:
        return bool(c.encode(codec))
    except UnicodeEncodeError:
        return False


@functools.cache
def _chinese() -> frozenset[str]:
    """Characters of the Chinese standards (GB 2312, Big5) that the Japanese one (JIS X 0208) does not have, and some function words."""
    han = map(chr, range(0x4E00, 0xA000))
    return frozenset(c for c in han if (_encodes(c, "gb2312") or _encodes(c, "big5")) and not _encodes(c, "shift_jis")) | frozenset(_CHINESE_WORDS)


def language(text: str) -> str | None:
    """ja, zh, ko, or a language of the word lists; null if the text doesn't show it."""
    hiragana = sum("ぁ" <= c <= "ゖ" for c in text)
    hangul = sum("가" <= c <= "힣" for c in text)
    han = sum("㐀" <= c <= "鿿" for c in text)
    if hangul >= 3 and hangul > hiragana:
        return "ko"
    marks = _chinese()
    chinese = sum(c in marks for c in text)
    if chinese >= 3 and chinese > 2 * hiragana:
        return "zh"
    if hiragana >= 2:
        return "ja"
    words = [w.lower() for w in _LATIN_WORD.findall(text)]
    if len(words) >= 3 and len(words) > han:
        score = {k: sum(w in s for w in words) for k, s in _word_sets().items()}
        best = max(score, key=lambda k: score[k])  # the first of the list in a tie
        if score[best] >= max(1, len(words) // 12):
            return best
    return None


def asked_languages(question: str) -> set[str]:
    low = question.lower()
    return {k for k, p in _REQUESTS.items() if re.search(p, low)}


@functools.cache
def _frame() -> int:
    return len(zstandard.ZstdCompressor(level=19, write_content_size=False).compress(b""))


def copy_cost(text: str, question: str) -> float:
    """Bytes of the text, compressed with the question as dictionary, for each byte of it."""
    raw, asked = text.encode("utf-8", "surrogatepass"), question.encode("utf-8", "surrogatepass")
    prompt = zstandard.ZstdCompressionDict(asked, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    # window and tables hold the question and the text, however long they are
    bits = (len(raw) + len(asked)).bit_length()
    parameters = zstandard.ZstdCompressionParameters(window_log=min(27, max(16, bits)), chain_log=min(27, max(10, bits)), hash_log=min(26, max(10, bits)), search_log=4, min_match=3, target_length=64, strategy=zstandard.STRATEGY_BTOPT, write_content_size=False, write_checksum=False, write_dict_id=False)
    return (len(zstandard.ZstdCompressor(dict_data=prompt, compression_params=parameters).compress(raw)) - _frame()) / len(raw)


def _letters(text: str) -> str:
    return "".join(c for c in text if c.isalnum()).lower()


def is_copy(form: str, question: str) -> bool:
    a, q = _letters(form), _letters(question)
    if len(q) < 4 or len(a) < COPY_LENGTH * len(q) or len(a) > 4 * len(q) + 20:
        return False
    if a == q:
        return True
    if copy_cost(a, q) > COPY_COST:
        return False
    grams = {q[i : i + 3] for i in range(len(q) - 2)}
    own = [a[i : i + 3] for i in range(len(a) - 2)]
    return bool(own) and sum(g in grams for g in own) >= COPY_COVER * len(own)


def is_refusal(form: str) -> bool:
    bare = _QUOTED.sub("", form)
    m = _REFUSALS.search(bare)
    if not m:
        return False
    rest = _POLITE_REST.sub("", bare[: m.start()] + "。" + bare[m.end() :])
    return len(_letters(rest)) <= REFUSAL_REST


def is_empty(form: str) -> bool:
    bare = _letters(form)
    return not bare or form.strip().strip("()（）[]<>【】「」-.…・ ").lower() in _PLACEHOLDERS


def defect(text: str | None, question: str | None, field: str) -> str | None:
    """empty, copy, refusal or language; null for none of them."""
    form = _TAG.sub("", canonical(text or "")).strip()
    if field == "answer" and is_empty(form):
        return "empty"
    if not form:
        return None
    ask = _TAG.sub("", canonical(question or "")).strip()
    if ask and is_copy(form, ask):
        return "copy"
    if is_refusal(form):
        return "refusal"
    own, of_question = language(form), language(ask)
    if own and of_question and own != of_question and own not in asked_languages(ask):
        return "language"
    return None


def pair_fields(df: DataFrame) -> DataFrame:
    """(item_id, field_name, question, text, source) for each field of rows (item_id, question, answer, thinking, qa_generator)."""
    fields = [F.struct(F.lit(f).alias("field_name"), F.col(f).alias("text")) for f in ("answer", "thinking")]
    return df.select("item_id", "question", F.col("qa_generator").alias("source"), F.explode(F.array(*fields)).alias("f")).select("item_id", "f.field_name", "question", "f.text", "source")


def defects(df: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """(item_id, field_name, defect) of the defective fields of rows (item_id, question, answer, thinking, qa_generator).

    others are further values, as truncation.values gives them, whose sentence ends the terminal contexts are learned from too.
    A null thinking text is no defect, a null answer is empty; a null question allows neither copy nor
    language. Very long texts and repeated rows pass (a row of each); an empty table gives no rows.
    """
    fields = pair_fields(df)

    def kernel(batch: pa.RecordBatch) -> dict | None:
        columns = (batch.column(c).to_pylist() for c in ("text", "question", "field_name"))
        found = [None if t is None and f != "answer" else defect(t, q, f) for t, q, f in zip(*columns, strict=True)]
        keep = np.flatnonzero([x is not None for x in found])
        if not len(keep):
            return None
        at = pa.array(keep)
        return {"item_id": batch.column("item_id").take(at), "field_name": batch.column("field_name").take(at), "defect": [found[i] for i in keep]}

    item = dict(df.dtypes)["item_id"]
    plain = arrow_map(fields.select("item_id", "field_name", "question", "text"), "text", f"item_id {item}, field_name string, defect string", kernel)
    ends = fields.select(F.lit("qa_row").alias("tbl"), F.col("item_id").cast("string").alias("row_key"), "field_name", "source", "text")
    cut = truncated(ends if others is None else ends.union(others))[0].where("cut and tbl = 'qa_row'").select(F.col("row_key").cast(item).alias("item_id"), "field_name", F.lit("truncated").alias("defect"))
    # the other labels come first
    first = F.min_by("defect", F.when(F.col("defect") == "truncated", 1).otherwise(0)).alias("defect")
    return plain.union(cut).groupBy("item_id", "field_name").agg(first)


def _defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return defects(table(spark, sf_dir, "qa_row"), values(spark, sf_dir).where("tbl <> 'qa_row'"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _defects(spark, sf_dir)


def p6_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defects per generator and field."""
    rows = table(spark, sf_dir, "qa_row")
    found = _defects(spark, sf_dir).join(rows.select("item_id", "qa_generator"), "item_id")
    return found.groupBy("qa_generator", "field_name", "defect").agg(F.count("*").alias("n"))

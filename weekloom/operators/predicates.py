"""Rules about names, captions and polarity as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Surnames that a name starts with, words and endings that are no names, titles behind a name.
SURNAMES = tuple("김이박최정강조윤장임한오서신권황안송류유전홍고문양손배백허남심노하곽성차주우구민나지엄채원천방공현함변염여추도소석선마길위표명기반왕금옥육인맹제모탁국어은편용예경봉사부복목형계피두감음빈동온")
NOT_NAMES = ("기감", "도핑", "사브르", "전관", "신라젠", "인포섹")
NOT_NAME_ENDS = ("부", "과", "처", "청", "협", "망", "업", "학", "원", "대", "회", "단", "실", "국", "부서")
TITLES = tuple("의원 대표 장관 차관 대통령 후보 위원 위원장 의장 총리 시장 지사 군수 구청장 판사 검사 변호사 기자 앵커 교수 박사 회장 사장 부장 감독 선수 코치 작가 배우 가수 아나운서 총장 이사장 장군 목사 신부 씨 군 양 옹".split())
#: Tags in front of captions, titles and sources at their ends, and words of decline.
CAPTION_TAGS = ("부고", "인사", "동정", "포토", "화보", "사진", "그래픽", "표", "일정", "날씨", "증시", "환율", "라운지", "게시판", "경제계 인사", "모집")
CAPTION_TITLES = tuple("회장 부회장 사장 대표 대표이사 의원 장관 차관 위원장 위원 교수 소방서 경찰서 본부장 이사장 청장 시장 지사 총장 원장 국장 과장 부장 팀장 단장 감독 작가 배우 가수 선수".split())
CAPTION_ENDS = ("제공", "조감도", "자료사진", "갈무리", "캡처", "모습", "연합뉴스", "뉴시스", "게티이미지")
DECLINE = "약화|감소|축소"


def caption_pattern(tags: tuple[str, ...] = CAPTION_TAGS, titles: tuple[str, ...] = CAPTION_TITLES, ends: tuple[str, ...] = CAPTION_ENDS) -> str:
    """A tag in brackets in front, or one of the titles or sources at the end, with a full stop or without."""
    return rf"^\[({'|'.join(tags)})\]|({'|'.join((*titles, *ends))})\s*[.·]?\s*$"


CAPTION = caption_pattern()


def name_like(word: Column, shortest: int = 2, longest: int = 3) -> Column:
    """Hangul only, of a name's length, with a surname in front, and no word or ending that names don't have."""
    ends = F.exists(F.array(*map(F.lit, NOT_NAME_ENDS)), lambda e: F.endswith(word, e))
    return word.rlike("^[가-힣]+$") & F.length(word).between(shortest, longest) & F.substring(word, 1, 1).isin(list(SURNAMES)) & ~word.isin(list(NOT_NAMES)) & ~ends


def caption(line: Column, shortest: int) -> Column:
    """A line that is no sentence: very short, or with the marks of a caption."""
    plain = F.trim(line)
    return (F.length(plain) <= shortest) | plain.rlike(CAPTION)


def polarity(text: Column) -> Column:
    return F.when(F.contains(F.lower(text), F.lit("decline")) | text.rlike(DECLINE), "Fading").otherwise("Active")


def before_titles(lines: DataFrame, id_col: str, line: str, words: DataFrame, word: str) -> DataFrame:
    """(word, hits): in how many lines a word stands right before a title. An equi-join on the word."""
    tokens = F.split(F.trim(line), r"\s+")
    pairs = F.transform(F.sequence(F.lit(1), F.size(tokens) - 1), lambda i: F.struct(F.element_at(tokens, i).alias("w"), F.element_at(tokens, i + 1).alias("next")))
    found = lines.where(F.size(tokens) > 1).select(id_col, F.inline(pairs))
    found = found.where(F.regexp_replace("next", r"[^\p{L}\p{N}_]+$", "").isin(list(TITLES)))
    return found.select(id_col, "w").distinct().join(words.select(F.col(word).alias("w")), "w").groupBy(F.col("w").alias(word)).agg(F.count("*").alias("hits"))

"""Document families as profiles: what the operators need to know about a family, as data and Column factories.

A profile's hooks return expressions, not functions of single rows, so that the optimizer sees through them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.columns import strip

# Level-two headings and the section that each opens.
SECTION_BY_HEADING = {
    "서론": "intro",
    "감사인의 전반적인 목적": "overall_objective",
    "목적": "purpose",
    "용어의 정의": "definitions",
    "요구사항": "requirements",
    "적용 및 기타 설명자료": "application",
    "일반원칙과 책임": "general_principles",
    "회계법인의 윤리적 요구사항 준수": "ethical_requirements",
    "감사업무의 수임 또는 유지": "engagement_acceptance",
    "감사계약의 수임 및 유지": "engagement_acceptance",
    "감사 계획": "planning",
    "중요성": "materiality",
    "위험평가": "risk_assessment",
    "평가된 위험에 대한 감사인의 대응": "risk_response",
    "평가된 위험에 대한 대응": "risk_response",
    "결론 및 보고": "conclusion_reporting",
    "결론형성과 보고": "conclusion_reporting",
    "기타 고려사항": "other_considerations",
}

# Framework headings and the section that each opens.
FRAMEWORK_SECTION_BY_HEADING = {
    "서론": "intro",
    "윤리 원칙과 품질관리기준": "ethical_requirements_and_quality",
    "인증업무의 의의": "assurance_definition",
    "입증업무와 직접업무": "attestation_vs_direct",
    "합리적 확신업무와 제한적 확신업무": "reasonable_vs_limited_assurance",
    "개념체계의 범위": "framework_scope",
    "비인증업무보고서": "non_assurance_reports",
    "인증업무의 전제조건": "assurance_preconditions",
    "인증업무의 구성 요소": "assurance_components",
    "삼자관계": "three_party_relationship",
    "기초인증대상": "underlying_subject_matter",
    "준거기준": "criteria",
    "증거": "evidence",
    "인증보고서": "assurance_report",
    "기타 사항": "other_matters",
    "인증인 명칭의 부적절한 사용": "inappropriate_use_of_name",
}

# Primary headings of a two-column body table, and texts of its column headers.
TABLE_SECTIONS = ["서론", "시행일", "목적", "용어의 정의", "요구사항", "적용 및 기타 설명자료"]
TABLE_HEADERS = ["문단번호"]

# Headings below the primary ones in a two-column body table.
TABLE_SUBSECTIONS = [
    "이 품질관리기준서의 효력",
    "관련 요구사항의 적용과 준수",
    "품질관리시스템의 구성요소",
    "회계법인내 품질에 대한 리더십 책임",
    "관련 윤리적 요구사항",
    "독립성",
    "의뢰인 관계 및 특정 업무의 수용과 유지",
    "인적 자원",
    "업무팀의 배정",
    "업무의 수행",
    "모니터링",
    "“회계법인”, “네트워크”, “네트워크 회계법인”의 정의",
    "유착위협",
    "의뢰인 관계의 유지",
    "의뢰인관계 및 특정 업무의 수용과 유지",
    "의뢰인의 성실성",
    "관련 윤리적 요구사항의 준수",
    "업무팀",
    "업무수행이사",
    "업무수행품질의 일관성",
    "감독",
    "검토",
    "업무의 해지",
    "서면확인서",
    "업무문서화",
    "업무의 문서화",
    "업무문서의 소유권",
    "업무문서의 보존",
    "업무문서의 비밀유지, 안전한 보관, 무결성, 접근성 및 재생가능성",
    "업무품질관리검토",
    "업무품질관리검토의 기준",
    "업무품질관리검토 의 성격, 시기 및 범위",
    "업무품질관리검토자의 적격성 기준",
    "업무품질관리검토자의 객관성",
    "업무품질관리검토자의 자문",
    "업무품질관리검토의 문서화",
    "상장기업에 대한 업무품질관리검토",
    "식별된 미비점에 대한 평가, 커뮤니케이션 및 해결",
    "미비점의 커뮤니케이션",
    "고충과 진정",
    "고충과 진정의 원천",
    "공공부문 감사조직에 특유한 고려 사항",
    "공공부문 감사조직에 특유한 고려사항",
    "소규모 회계법인에 특유한 고려 사항",
    "소규모 회계법인에 특유한 고려사항",
    "이 품질관리기준서의 범위",
    "자문",
    "의견의 차이",
    "적격성, 역량과 자원",
    "조사 정책과 절차",
    "최종업무파일의 취합 완료",
    "최종업무파일의 취합완료",
    "충분하고 적합한 기술적 전문성, 경험 및 권한",
    "품질관리시스템의 문서화",
    "품질에 대한 내부문화의 촉진",
    "회계법인 품질관리시스템의 운영책임 지정",
    "회계법인의 품질관리정책과 절차에 대한 모니터링",
]

# Parts of file names and the family that each names.
FAMILY_BY_FILE_NAME = [("인증업무개념체계", "FRMK"), ("품질관리기준서", "ISQM"), ("역사적 재무정보", "ASSR"), ("이외의 인증업무기준", "ASSR"), ("회계감사기준", "ISA")]

# Styles and patterns that mark structure.
TOC_STYLES = ["목차", "ad"]
APPENDIX_STYLE = "보론 제목"
UNIT_HEADING = r"^감사기준서\s+(\d{3,4})(?:\s+(.+))?$"
UNIT_NAME = "감사기준서 "
APPENDIX_HEADING = r"^보론\s*\d+\b"
APPENDIX_PREFIX = "부록-"
SCOPE_HEADING = "이 감사기준서의 범위"
DEFINITIONS_APPENDIX = ("1200", "보론 1")
TOC_NOISE = ["목차", "문단번호"]
DEFAULT_COLLECTION = "audit_standards"
COLLECTION_BY_STANDARD = {
    "ISQM-1": "audit_standards_품질관리기준서_2018",
    "ASSR-3000": "audit_standards_기타인증업무기준_2022",
    "FRMK-1": "audit_standards_인증업무개념체계_2022",
}


def numbered_appendix(heading: Column) -> Column:
    """struct(index, name): `보론 N` gives N, an unnumbered one 1."""
    h = strip(heading)
    number = F.regexp_extract(h, r"^보론\s*(\d+)\b", 1)
    index = F.when(number != "", number.cast("int")).when(h.rlike(r"^보론(?!\s*\d)"), F.lit(1))
    return F.struct(index.alias("index"), F.lit(None).cast("string").alias("name"))


def named_appendix(heading: Column) -> Column:
    """struct(index, name): `보론 N` gives N, an unnumbered one its name."""
    h = strip(heading)
    number = F.regexp_extract(h, r"^보론\s*(\d+)\s*[:.]?", 1)
    named = h.rlike(r"^보론\s*[:.]")
    index = F.when(number != "", number.cast("int"))
    name = F.when((number == "") & named, strip(F.regexp_extract(h, r"(?s)^보론\s*[:.]\s*(.*)", 1)))
    return F.struct(index.alias("index"), name.alias("name"))


def starts_body(text: Column, style: Column) -> Column:
    return strip(text) == "서론"


def starts_framework(text: Column, style: Column) -> Column:
    return (style == "heading 2") & F.startswith(strip(text), F.lit("문단번호"))


@dataclass(frozen=True)
class Profile:
    """A family: how its ids look, what ends its prelude, how appendices are named, and where its body lies."""

    prefix: str
    id_pattern: str
    default_no: str | None = None
    prelude_marker: Callable[[Column, Column], Column] | None = None
    appendix: Callable[[Column], Column] = numbered_appendix
    body_table: bool = False
    table_rows: bool = False
    strips_ranges: bool = False
    sections: dict[str, str] = field(default_factory=lambda: dict(SECTION_BY_HEADING))

    @property
    def descends(self) -> bool:
        """Whether paragraphs within tables are read as paragraphs of the body too."""
        return self.prefix != "ISA" and not self.body_table


PROFILES = {
    "ISA": Profile("ISA", r"^ISA-\d{3,4}$"),
    "ISQM": Profile("ISQM", r"^ISQM-\d{1,2}$", default_no="1", body_table=True),
    "ASSR": Profile("ASSR", r"^ASSR-\d{3,4}$", default_no="3000", prelude_marker=starts_body),
    "FRMK": Profile("FRMK", r"^FRMK-\d$", default_no="1", prelude_marker=starts_framework, appendix=named_appendix, table_rows=True, strips_ranges=True, sections=dict(FRAMEWORK_SECTION_BY_HEADING)),
}
NUMBER_PATTERN = r"^\d{1,4}$"


def standard_id(prefix: str, number: Column, checked: bool = True) -> Column:
    """PREFIX-number; raises where the number or the id doesn't fit the family's patterns, unless that is left to valid_standard_id()."""
    made = F.concat(F.lit(f"{prefix}-"), number)
    if not checked:
        return made
    fits = number.rlike(NUMBER_PATTERN) & made.rlike(PROFILES[prefix].id_pattern)
    return F.when(number.isNull() | fits, made).otherwise(F.raise_error(F.concat(F.lit("[STANDARD_ID] not of the family: "), made)).cast("string"))


def valid_standard_id(found: Column) -> Column:
    """Whether an id is of the family that its prefix names; false for families that are unknown, null for null."""
    cases = F.lit(False)
    for prefix, profile in PROFILES.items():
        cases = F.when(F.split_part(found, F.lit("-"), F.lit(1)) == prefix, found.rlike(profile.id_pattern)).otherwise(cases)
    return F.when(found.isNotNull(), cases)


def profile_of(standard: str) -> Profile:
    """The profile of an id: an id without a family, an unknown family and an id that doesn't fit it are three errors."""
    import re

    prefix, dash, _ = standard.partition("-")
    if not dash:
        raise ValueError(f"[STANDARD_ID] no family in {standard!r}")
    if prefix not in PROFILES:
        raise ValueError(f"[FAMILY] unknown: {prefix!r}; known: {sorted(PROFILES)}")
    if not re.search(PROFILES[prefix].id_pattern, standard):
        raise ValueError(f"[STANDARD_ID] not of the family: {standard!r}")
    return PROFILES[prefix]


def family_of(file_name: Column, override: str | None = None) -> Column:
    """The family that a file name tells; raises where none or several match. An override wins."""
    if override is not None:
        if override not in PROFILES:
            raise ValueError(f"[FAMILY] unknown: {override!r}; known: {sorted(PROFILES)}")
        return F.lit(override)
    hits = F.array_distinct(F.array_compact(F.array(*(F.when(F.contains(file_name, F.lit(part)), F.lit(prefix)) for part, prefix in FAMILY_BY_FILE_NAME))))
    told = F.concat(F.lit("[FAMILY] "), F.when(F.size(hits) == 0, F.lit("no family in file name: ")).otherwise(F.lit("several families in file name: ")), file_name)
    return F.when(F.size(hits) == 1, F.element_at(hits, 1)).otherwise(F.raise_error(told).cast("string"))


def collection_of(found: Column, default: str) -> Column:
    """The collection of a standard's points."""
    out = F.lit(default)
    for standard, name in COLLECTION_BY_STANDARD.items():
        out = F.when(found == standard, F.lit(name)).otherwise(out)
    return out

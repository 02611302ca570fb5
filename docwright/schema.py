"""The document schema: every field, its type and its inclusive bounds.

Objects are closed, and every member is required unless named in optional.
The table below is fixed values; the typed Spark schema is derived from it.
"""

from dataclasses import dataclass, field

from pyspark.sql import types as S


@dataclass(frozen=True)
class Text:
    low: int | None = None
    high: int | None = None
    pattern: str | None = None
    values: tuple | None = None
    nullable: bool = False


@dataclass(frozen=True)
class Whole:
    low: int
    high: int
    nullable: bool = False


@dataclass(frozen=True)
class Number:
    low: float
    high: float


@dataclass(frozen=True)
class Flag:
    pass


@dataclass(frozen=True)
class Items:
    item: object
    low: int
    high: int
    unique: bool = False


@dataclass(frozen=True)
class Members:
    members: dict = field(default_factory=dict)
    optional: tuple = ()


MONEY = Whole(0, 50_000_000)
SALARY = Whole(0, 100_000_000)
YEARS = Number(0.5, 10)

# Field names, bounds, choices and patterns of the document.
DOCUMENT = Members({
    "course_id": Text(1, 64),
    "slug": Text(3, 80, pattern=r"^[a-z0-9]+(-[a-z0-9]+)*$"),
    "course_name": Text(3, 90),
    "course_level": Text(values=("Undergraduate", "Postgraduate", "Diploma", "Certificate", "Doctoral")),
    "category": Text(3, 60),
    "subcategory": Text(2, 60),
    "currency": Text(values=("INR", "USD", "GBP", "EUR", "AED")),
    "region": Text(2, 60),
    "seo": Members({"page_title": Text(10, 70), "meta_description": Text(50, 160)}),
    "hero": Members({
        "badge": Text(3, 40),
        "summary": Text(150, 420),
        "fit": Members({
            "score_percent": Whole(0, 100),
            "note": Text(20, 120),
            "indicators": Items(Text(10, 70), 3, 3),
        }),
    }),
    "quick_facts": Members({
        "typical_duration": Members({"min_years": YEARS, "max_years": YEARS}),
        "entry_level": Text(3, 40),
        "suitable_streams": Items(Text(3, 30), 1, 5, unique=True),
        "learning_style": Text(10, 60),
        "indicative_annual_fees": Members({"min": MONEY, "max": MONEY}),
        "career_direction": Text(10, 70),
    }),
    "snapshot": Members({
        "salary": Members({
            "lower_annual": SALARY,
            "typical_annual": SALARY,
            "higher_annual": SALARY,
            "higher_is_open_ended": Flag(),
            "marker_percent": Whole(0, 100),
            "note": Text(60, 320),
        }),
        "specialisations": Items(Text(4, 45), 8, 8, unique=True),
        "data_note": Text(60, 320),
    }),
    "overview": Members({"heading": Text(8, 80), "paragraphs": Items(Text(120, 600), 3, 3)}),
    "suitability": Members({
        "good_fit": Members({"heading": Text(10, 70), "points": Items(Text(20, 140), 4, 4)}),
        "caution": Members({"heading": Text(10, 70), "points": Items(Text(20, 140), 4, 4)}),
        "tags": Items(Text(3, 30), 7, 7, unique=True),
    }),
    "eligibility": Members({
        "typical_requirements": Items(Text(20, 140), 4, 4),
        "admission_methods": Items(Text(10, 140), 4, 4),
        "admission_timeline": Items(
            Members({"step": Whole(1, 5), "title": Text(5, 40), "description": Text(20, 120)}), 5, 5
        ),
    }),
    "curriculum": Members({
        "years": Items(
            Members({
                "year": Whole(1, 5),
                "label": Text(4, 20),
                "subjects": Items(Members({"name": Text(4, 60), "description": Text(20, 120)}), 4, 4),
            }),
            1, 5,
        ),
        "learning_activities": Text(60, 300),
        "assessment_methods": Text(60, 300),
    }),
    "skills": Items(Members({"name": Text(4, 40), "description": Text(20, 120)}), 6, 6),
    "careers": Items(
        Members({
            "title": Text(4, 50),
            "description": Text(30, 160),
            "route_badge": Text(values=(
                "Possible after bachelor's", "Training may be required", "Postgraduate route",
                "Advanced regulated route", "Higher study required",
            )),
            "typical_route": Text(15, 110),
        }),
        6, 6,
    ),
    "recruiters": Items(
        Members({
            "logo_initials": Text(pattern=r"^[A-Z]{2}$"),
            "name": Text(3, 60),
            "sector": Text(5, 45),
            "description": Text(40, 180),
            "roles": Items(Text(3, 30), 2, 2, unique=True),
        }),
        6, 6,
    ),
    "further_study_pathway": Items(Text(4, 35), 5, 5),
    "fees": Members({
        "rows": Items(
            Members(
                {
                    "category": Text(4, 40),
                    "institution_type": Text(
                        values=("government", "government_aided", "private", "premier_national"), nullable=True
                    ),
                    "min": Whole(0, 50_000_000, nullable=True),
                    "max": Whole(0, 50_000_000, nullable=True),
                    "is_variable": Flag(),
                    "frequency": Text(values=(
                        "Per year", "Per semester", "One time", "Total programme", "As required",
                    )),
                    "parent_check": Text(15, 120),
                },
                optional=("institution_type",),
            ),
            4, 8,
        ),
        "footnote": Text(40, 220),
    }),
    "colleges": Members({
        "ranking_source": Text(5, 80),
        "ranking_updated": Text(pattern=r"^[0-9]{4}-(0[1-9]|1[0-2])$"),
        "items": Items(
            Members({
                "rank": Whole(1, 6),
                "name": Text(5, 90),
                "city": Text(3, 40),
                "course_name": Text(3, 60),
                "duration_years": YEARS,
                "institution_type": Text(values=("government", "private")),
                "admission_route": Text(4, 40),
                "highlight": Text(4, 40),
                "annual_fee": MONEY,
            }),
            6, 6,
        ),
        "data_note": Text(60, 400),
    }),
    "comparison": Items(
        Members({
            "course_name": Text(3, 60),
            "main_focus": Text(10, 80),
            "statistics_level": Text(3, 40),
            "laboratory_exposure": Text(3, 40),
            "common_next_steps": Text(10, 80),
        }),
        3, 3,
    ),
    "action_roadmap": Items(
        Members({
            "stage": Text(values=("Grades 8-10", "Grade 11", "Grade 12")),
            "title": Text(3, 30),
            "description": Text(40, 220),
        }),
        3, 3,
    ),
    "parent_corner": Members({"intro": Text(620, 1400), "questions": Items(Text(20, 110), 6, 6, unique=True)}),
    "faqs": Items(Members({"question": Text(15, 110), "answer": Text(80, 420)}), 5, 10),
    "verification": Members({
        "last_reviewed": Text(pattern=r"^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$"),
        "sources": Items(
            Members({"title": Text(5, 140), "url": Text(pattern=r"^https://"), "publisher": Text(2, 80)}), 3, 15
        ),
    }),
})


def spark_type(spec) -> S.DataType:
    """Typed form of a field, for reading documents whose rules are checked."""
    if isinstance(spec, Text):
        return S.StringType()
    if isinstance(spec, Whole):
        return S.LongType()
    if isinstance(spec, Number):
        return S.DoubleType()
    if isinstance(spec, Flag):
        return S.BooleanType()
    if isinstance(spec, Items):
        return S.ArrayType(spark_type(spec.item))
    return S.StructType([S.StructField(name, spark_type(child)) for name, child in spec.members.items()])


DOCUMENT_TYPE = spark_type(DOCUMENT)

#: Reads the JSON text of every root property; of a string, its value. Nothing below the root is kept apart.
RAW_TYPE = S.StructType([S.StructField(name, S.StringType()) for name in DOCUMENT.members])

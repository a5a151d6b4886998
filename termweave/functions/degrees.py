"""Degree titles and majors: filters and the ordered major rules."""

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks that make a title a bachelor's degree.
BACHELOR_MARKS = ["BACHELOR", "BS", "BA", "AB"]

# Marks of an associate's degree or certificate, and of what is neither.
ASSOCIATE_MARKS = ["ASSOCIATE", "CERTIF", "AA ", "AS ", "CA "]
NOT_ASSOCIATE_MARKS = ["POST-BACCALAUREATE", "GRADUATE"]


def _contains_any(c: Column, marks: list[str]) -> Column:
    return reduce(Column.__or__, [c.contains(mark) for mark in marks])


def bachelor_filter(title: Column) -> Column:
    """True for a bachelor's title and for a missing one."""
    return _contains_any(title, BACHELOR_MARKS) | title.isNull()


def associate_filter(title: Column) -> Column:
    """True for associate's and certificate titles.

    A missing title makes the exclusions NULL, so such rows are dropped, and so is
    every title with GRADUATE inside, UNDERGRADUATE ones too.
    """
    return ~_contains_any(title, NOT_ASSOCIATE_MARKS) & _contains_any(title, ASSOCIATE_MARKS)


class Rule(NamedTuple):
    kind: str  # "exact" or "contains"
    pattern: str
    label: str

    def test(self, c: Column) -> Column:
        return c == self.pattern if self.kind == "exact" else c.contains(self.pattern)


# Labels of the CRM's major picklist that a rule can yield.
ART = "Arts: Design, Performing, or Visual"
BIO = "Biological, Environmental, or Agricultural Sciences"
BUS = "Business"
CHE = "Chemistry, Physics, or other Physical Sciences"
COM = "Communications or Marketing"
CSI = "Computer Science or Information Technology"
ENG = "Engineering or Architecture"
HLT = "Health Sciences"
LAH = "Liberal Arts or History"
LIT = "Literature or Languages"
MAT = "Math or Statistics"
PSY = "Psychology"
SOC = "Sociology, Political Science, Economics, or other Social Sciences"
UND = "Undeclared"
MAJOR_ERROR = "ERROR!"

# Rules from a reported major to a label; the first that fits decides.
EXACT_MAJORS = [
    ("ASSOCIATE OF ARTS", LAH),
    ("CAD (EARLY CHILDHOOD)-BA", SOC),
    ("SPANISH", LIT),
    ("NURSING", HLT),
    ("ACCOUNTING", BUS),
    ("MANAGEMENT", BUS),
    ("BUSINESS ADMINISTRATION", BUS),
    ("MULTIMEDIA DESIGN & DEVELOPMENT", ART),
    ("ASSOCIATE OF SCIENCE", BIO),
    ("URBAN AND REGIONAL PLANNING", ENG),
    ("ARCHITECTURE", ENG),
]
MAJOR_WORDS = [
    ("BIOLOG", BIO),
    ("KINES", CHE),
    ("NATURAL SCI", CHE),
    ("PUBLIC HEALTH", HLT),
    ("NURS", BIO),
    ("PHARM", HLT),
    ("MATH", MAT),
    ("ECON", SOC),
    ("COMPUTER SCIENCE", CSI),
    ("ELECTRICAL", ENG),
    ("MECHANICAL", ENG),
    ("TECH", CSI),
    ("MULTIMEDIA", ART),
    ("PSYCHOLOGY", PSY),
    ("HISTORY", LAH),
    ("SOCIOLOGY", SOC),
    ("SOCIAL", SOC),
    ("HUMAN DEVELOPMENT", SOC),
    ("BEHAV", SOC),
    ("CHILD", SOC),
    ("CLINIC", HLT),
    ("ADOLESCENT", SOC),
    ("THERAPY", HLT),
    ("BROADCAST", COM),
    ("BUSINESS", BUS),
    ("MGMT", BUS),
    ("COMMUNICATION ", COM),
    ("JUSTICE", SOC),
    ("CRIMINAL", SOC),
    ("HUMANITIES", LAH),
    ("ASSOCIATE OF ARTS ", LAH),
    ("SIGN LANGUAGE", LIT),
    ("AMERICAN", SOC),
    ("CULINARY", ART),
    ("FIREFIGHTER", BIO),
    ("IGETC", UND),
    ("TRANS", UND),
    ("BREADTH", UND),
    ("LIB", LAH),
    ("GENERAL ", LAH),
]


def major_rules(any_multimedia: bool) -> list[Rule]:
    """The rule list; products differ only in how they treat multimedia majors.

    With ``any_multimedia`` each major that contains the word is an art, else only the
    one exact title is.
    """
    exact = [
        Rule("exact", text, label)
        for text, label in EXACT_MAJORS
        if not (any_multimedia and text.startswith("MULTIMEDIA"))
    ]
    words = [
        Rule("contains", text, label)
        for text, label in MAJOR_WORDS
        if any_multimedia or text != "MULTIMEDIA"
    ]
    return exact + words


def classify(c: Column, rules: list[Rule], default: str = MAJOR_ERROR) -> Column:
    """Label of the first rule that fits; NULL stays NULL, no fit gives ``default``."""
    label = F.when(c.isNull(), F.lit(None).cast("string"))
    for rule in rules:
        label = label.when(rule.test(c), rule.label)
    return label.otherwise(default)

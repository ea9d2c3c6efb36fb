import unicodedata

import pytest
from pyspark.sql import functions as F

from stratalex.functions import html, udfs
from stratalex.functions import similarity as sm
from stratalex.functions import text as tx
from stratalex.policies import InstitutionPolicy, LabelPolicy, NearDuplicatePolicy

LABEL = LabelPolicy()


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("given", "level", "institution", "canonical"),
    [
        ("Department of Physics", 1, None, "physics"),
        ("dept. of Earth  Sciences", 1, None, "earth sciences"),
        ("Centre for Quantum Optics", 2, None, "quantum optics"),
        ("Workshop on Graph Learning", 3, None, "graph learning"),
        ("State U - School of Law", 0, "State U", "law"),
        ("State U – Engineering", 0, "state u", "engineering"),
        ("Computer Science (CS)", 1, None, "computer science"),
        ("Bio-Informatics: Methods/Tools", 2, None, "bio informatics methods tools"),
        ("Ingénierie Électrique", 1, None, "ingenierie electrique"),
        ("Labs (a long closing note)", 2, None, "labs a long closing note"),
    ],
)
def test_canonical_form(spark, given, level, institution, canonical):
    owner = F.lit(institution) if institution else None
    found = value(spark, tx.canonical_form(F.lit(given), level, LABEL, owner))
    assert found["canonical"] == canonical
    assert len(found["aliases"]) == len(set(found["aliases"])) and " ".join(given.split()) in found["aliases"]


def test_aliases_keep_cut_forms_and_acronyms(spark):
    found = value(spark, tx.canonical_form(F.lit("Department of Electrical Engineering (EE)"), 1, LABEL))["aliases"]
    assert found[:2] == ["Department of Electrical Engineering (EE)", "electrical engineering"]
    assert "Electrical Engineering (EE)" in found and "EE" in found and "electrical engineering" in found


def test_ambiguous_acronyms_need_policy_or_context(spark):
    def expand(acronym, level, context, policy=LABEL):
        return value(spark, tx.expand_acronym(F.lit(acronym), level, F.lit(context), policy))

    assert expand("AI", 0, "the AI group") is None
    assert expand("AI", 3, "artificial intelligence (AI)") == "artificial intelligence"
    assert expand("AI", 1, "AI", LabelPolicy(include_ambiguous_acronyms=True)) == "artificial intelligence"
    assert expand("EECS", 1, "x") == "electrical engineering and computer science" and expand("EECS", 2, "x") is None


def test_acronym_detection(spark):
    assert value(spark, tx.acronyms(F.lit("THE R&D of NLP and NLP at MIT, ABCDEFGH OF"))) == ["NLP", "MIT"]
    assert value(spark, tx.acronym_of(F.lit("N.L.P."))) == "NLP"
    assert value(spark, tx.acronym_of(F.lit("Physics"))) is None
    assert value(spark, tx.abbreviates(F.lit("NLP"), F.lit("natural language processing"))) == 1.0
    assert value(spark, tx.abbreviates(F.lit("operations research"), F.lit("OR"))) == 1.0
    assert value(spark, tx.abbreviates(F.lit("STAT"), F.lit("statistics"))) == 1.0
    assert value(spark, tx.abbreviates(F.lit("XYZ"), F.lit("natural language processing"))) == 0.0


def test_folding(spark):
    plain = "Straße naïve Ångström Ελλάδα ёлка façade"
    want = "".join(c for c in unicodedata.normalize("NFKD", plain) if not unicodedata.combining(c))
    assert value(spark, tx.fold_diacritics(F.lit(plain))) == want
    rows = spark.createDataFrame([(plain,), ("ﬁ ½ ascii",), ("ascii",), (None,)], "t string")
    assert [r[0] for r in rows.select(udfs.fold_diacritics_full(F.col("t"))).collect()] == [want, "fi 1⁄2 ascii", "ascii", None]


def test_institutions(spark):
    policy = InstitutionPolicy(canonical_mappings={"Tech Univ": "Technical University"})
    resolve = lambda name, p=policy: value(spark, tx.resolve_institution(F.lit(name), p))
    assert resolve("  university   OF the north ") == "University OF the North"
    assert resolve("tech  univ") == "Technical University"
    assert resolve("unknown").startswith("placeholder::") and resolve(" ").startswith("placeholder::") and resolve("unknown") != resolve("")
    assert resolve("State University at Bay City", InstitutionPolicy("prefer-system")) == "State University"
    assert resolve("State University, Bay City", InstitutionPolicy("prefer-system")) == "State University"
    assert resolve("State University, Bay City", InstitutionPolicy("merge")) == "State University Bay City"


@pytest.mark.parametrize(("print_", "key"), [("record::abc", "record"), ("page::1", "page::"), ("syllabus#v1", "syllabus"), ("paper-123#v1", "paper"), ("a#b", "a#b"), ("course_v12", "course"), ("note-deadbeef", "note")])
def test_near_duplicate_keys(spark, print_, key):
    assert value(spark, tx.near_duplicate_key(F.lit(print_), NearDuplicatePolicy())) == key


def test_similarities(spark):
    score = lambda m, a, b: value(spark, sm.similarity(m, F.lit(a), F.lit(b)))
    assert score("jaccard_shingles", "a b c d", "a b c d") == 1.0 and score("jaccard_shingles", "", " ") == 1.0 and score("jaccard_shingles", "a", "") == 0.0
    assert score("jaccard_shingles", "one two", "one three") == 0.0  # short texts are one shingle
    assert score("token_jaccard", "deep learning", "deep  LEARNING!") == 1.0
    assert score("jaro_winkler", "martha", "marhta") == pytest.approx(0.961111, abs=1e-6)
    assert score("jaro_winkler", "abc", "xyz") == 0.0
    assert abs(score("minhash", "a b c d e f g h", "a b c d e f g i") - 5 / 7) < 0.2
    assert score("combined", "ML", "machine learning") == 1.2
    with pytest.raises(ValueError, match="unknown similarity"):
        sm.similarity("cosine", F.lit("a"), F.lit("b"))


def test_winkler_against_known_values():
    for a, b, want in [("dwayne", "duane", 0.84), ("dixon", "dicksonx", 0.813333), ("a", "ab", 0.85), ("", "", 0.0), ("same", "same", 1.0), ("abcdef", "ghijkl", 0.0)]:
        assert udfs.winkler(a, b) == pytest.approx(want, abs=1e-5)


def test_affix_hint(spark):
    hint = lambda a, b: value(spark, tx.affix_hint(F.lit(a), F.lit(b), ("systems", "theory")))
    assert hint("Control Systems", "control") == 1.0 and hint("graph", "Theory graph") == 1.0
    assert hint("systems", "control") == 0.0 and hint("control", "control") == 0.0


def test_metaphone_groups_like_sounds():
    codes = udfs.metaphone_codes
    assert codes("Smith")[0] == codes("Smyth")[0] and codes("Catherine")[0] == codes("Kathryn")[0]
    assert codes("Philosophy")[0] == codes("Filosofy")[0] and codes("Knight") == codes("Night")
    assert len(codes("Schmidt")) == 2 and codes("123") == [] and codes(None) == [] and codes("") == []


def test_urls(spark):
    url = lambda u: value(spark, tx.normalize_url(F.lit(u)))
    assert url("HTTP://Ex.EDU#frag") == "http://ex.edu/" and url("https://a.org/p?q=1#x") == "https://a.org/p?q=1" and url("ftp://a.org") is None
    assert udfs.canonical("../b?x#y", "http://a.org/c/d") == "http://a.org/b?x" and udfs.canonical("mailto:x@y.z") is None
    follows = lambda u: value(spark, tx.follows(F.lit(u), (".edu",), ("/news",)))
    assert follows("https://cs.uni.edu/a") and not follows("https://uni.edu/news/1") and not follows("https://notedu/a") and not follows("https://uni.edu.evil.com/")


def test_html():
    page = '<html><head><title> A  title</title><link rel="canonical" href="/c"><meta name="description" content="said"><script>x()</script></head><body><nav>menu</nav><p>One<br>two</p><ul><li>first<ul><li>inner</li></ul></li><li>second</li></ul><ol><li>n</li></ol><a href="/l#f">link</a><a href="mailto:x">m</a></body></html>'
    text, link, title, description, links = html.read(page, "http://h.org/x")
    assert text.split("\n")[:6] == ["menu", "One", "two", "- first", "- inner", "- second"] and "1. n" in text and "x()" not in text
    assert (link, title, description, links) == ("http://h.org/c", "A title", "said", ["http://h.org/l"])
    assert html.read(None) == (None, None, None, None, []) and html.read("")[0] == ""
    assert html.clean("  a  b \n\n\n c\n") == "a b\n\nc"


def test_text_helpers(spark):
    assert value(spark, tx.clean_text(F.lit(" a  b \r\n\n\n\n c \n"))) == "a b\n\nc"
    assert value(spark, tx.capped_gloss(F.lit("one two three, four"), 3)) == "one two three..."
    assert value(spark, tx.sense_label(F.lit("Vision"), F.lit("vis"))) == "Vision" and value(spark, tx.sense_label(F.lit("Vision"), F.lit(" biology "))) == "Vision - biology"
    assert value(spark, tx.lineage_key(F.lit(2), F.array(F.lit("b"), F.lit("a")))) == "L2:b > a" and value(spark, tx.lineage_key(F.lit(0), F.array().cast("array<string>"))) == "L0:<root>"

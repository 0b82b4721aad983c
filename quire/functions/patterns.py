"""Word patterns of the rule chains.

Fixed values: these lists, their labels and their order define what the rules mean; results depend on
them, so they stand here together and plainly.
"""

LEARNING_OBJECTIVES = [r"^\s*learning objectives?\b", r"^\s*in this chapter, you will\b", r"^\s*after studying this chapter\b", r"^\s*what you will learn\b"]
KEY_TERMS = [r"^\s*key terms?\b", r"^\s*key concepts?\b", r"^\s*glossary\b"]
PROBLEM_SETS = [r"\bproblem sets?\b", r"\bproblems?\b", r"\bexercises?\b", r"\breview questions?\b", r"\bend[-\s]of[-\s]chapter problems?\b"]
CONCEPT_CHECK = [r"\bconcept checks?\b", r"\bconcept check\b"]
CONCEPT_CHECK_SOLUTION = [r"\bconcept check solutions?\b", r"\bconcept check answers?\b", r"\banswers to concept checks?\b", r"\bsolutions to concept checks?\b"]
PROCEDURE = [r"^\s*step\s+\d+\b", r"^\s*\d+\.\s+[A-Z]", r"^\s*\(\d+\)\s+[A-Z]"]
DERIVATION = [r"^\s*(?:derivation|proof)\b", r"\bwe\s+can\s+show\b", r"\bderive(?:d|s|ing)?\b", r"\bsubstitut(?:e|ed|ing|ion)\b", r"\brearrang(?:e|ed|ing)\b", r"\bsolve\s+for\b"]
CALCULATION = [r"\bcalculate\b", r"\bcompute\b", r"\bestimate\b", r"\bdetermine\b", r"\bfind\b", r"\busing\s+equation\b"]
SOLUTION = [r"^\s*solution\b", r"^\s*answer\b", r"\bsolution\s+to\b", r"\banswer\s+to\b"]
WORKED_EXAMPLE = [r"^\s*worked\s+example\b", r"^\s*example\s+\d+(?:\.\d+)*\b", r"^\s*illustration\b", r"\bgiven:\b", r"\bstep\s*1\b"]
BULLET = [r"^\s*[-•]\s+", r"^\s*\d+\)\s+", r"^\s*[A-Za-z]\)\s+", r"^\s*\(\d+\)\s+"]
REFERENCE_TITLE = [r"^\s*references?\b", r"^\s*bibliography\b"]

TRANSFORM = r"\b(?:derive(?:d|s|ing)?|substitut(?:e|ed|ing|ion)|rearrang(?:e|ed|ing)|solve\s+for|rewrite|differentiat(?:e|ed|ing|ion)|integrat(?:e|ed|ing|ion)|by\s+definition)\b"
EXPLICIT_DERIVATION = r"^\s*(?:\d+\s*[.)]\s*)?(?:derivation|proof)\b"
EQUATION_MENTION = r"\b(?:eq\.?|equation)\s*\(?\d+(?:\.\d+)*\)?"
WE_CAN_SHOW = r"\bwe\s+can\s+show\b"

FRONT_MATTER = [
    r"\btable of contents\b", r"\bbrief contents\b", r"\bcontents\b", r"\bcopyright\b", r"\ball rights reserved\b", r"\blibrary of congress\b",
    r"\bcataloging-in-publication\b", r"\bprinted in\b", r"\bisbn\b", r"\bwww\.\b", r"\bhttp[s]?://\b",
]
MAIN_BODY = [r"^(part|chapter)\b", r"^\d+(\.\d+)*\b", r"^第[一二三四五六七八九十0-9]+章"]
BACK_MATTER = [r"^index\b", r"^bibliography\b", r"^references\b", r"^appendix\b", r"^appendices\b", r"^glossary\b", r"^notation\b", r"^symbols?\b"]
SPECIAL_TERM = [r"\bdefinition\b", r"\bdefined as\b", r"\bglossary\b", r"\bnotation\b", r"\bsymbol\b", r"\bterm\b", r"\bkey term\b"]

CANDIDATE = [
    r"\bquestion\b", r"\bproblem\b", r"\bexercise\b", r"\bwhat\s+is\b", r"\bcalculate\b", r"\bdetermine\b", r"\bfind\b", r"\bexplain\b", r"\bdiscuss\b", r"\banalyze\b",
    r"\bsolution\b", r"\banswer\b", r"\btherefore\b", r"\bthus\b", r"\bwe\s+get\b", r"\bwe\s+find\b", r"\bderivation\b", r"\bproof\b", r"\bsubstitut(?:e|ing)\b",
    r"\bwe\s+can\s+show\b", r"\bworked\s+example\b", r"\billustration\b", r"\bgiven:\b", r"\bstep\s*1\b",
]
ANSWER_WORDS = r"\b(solution|answer|therefore|thus|we\s+find|we\s+get)\b"

TITLE_LABELS = [
    ("problem_sets", PROBLEM_SETS),
    ("concept_check_solution", CONCEPT_CHECK_SOLUTION),
    ("concept_check", CONCEPT_CHECK),
    ("key_terms", KEY_TERMS),
    ("learning_objectives", LEARNING_OBJECTIVES),
    ("references", REFERENCE_TITLE),
]

#: Cross-reference kinds in the order in which a text is searched; case matters.
CROSS_REFERENCES = [
    ("figure", r"\b(?:Figure|Fig\.?)\s+(\d+(?:\.\d+)*)"),
    ("table", r"\b(?:Table|Tbl\.?)\s+(\d+(?:\.\d+)*)"),
    ("equation", r"\b(?:Equation|Eq\.?)\s*\(?\s*(\d+(?:\.\d+)*)\s*\)?"),
    ("appendix", r"\b(?:Appendix)\s+([A-Z])"),
]

NUMBERING = [r"^(?:question\s+)?q?\s*(\d+(?:\.\d+)*)\s*(?:[\):.]|\s)", r"^\(?(\d+(?:\.\d+)*)\)?\s*(?:[\):.]|\s)", r"^(?:concept\s+check)\s+(\d+(?:\.\d+)*)\b"]
LIST_ITEM = [r"^[-•–—]", r"^\s*\d+\.\s+", r"^\s*\d+\)\s+", r"^\s*\(\d+\)\s+", r"^\s*[A-Za-z]\)\s+"]
PROCEDURE_ITEM = [r"^\s*step\s+\d+\b", r"^\s*(first|second|third|next|then|finally)[,:\s]"]
CONTINUATION = r"^(?:and |or |but |with |including |\()"

GREEK = ["alpha", "beta", "gamma", "delta", "sigma", "mu", "rho", "theta", "lambda", "pi"]
EQUATION_NUMBER = [r"\((\d+(?:\.\d+)*)\)\s*$", r"(?i)\b(?:Eq\.?|Equation)\s*\(?(\d+(?:\.\d+)*)\)?\b", r"\\tag\s*\{\s*(\d+(?:\.\d+)*)\s*\}"]

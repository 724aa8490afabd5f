"""What results must agree on. Everything here is data, no logic."""

# fixed values: values of letters, final forms included
LETTER_VALUES = {
    "א": 1, "ב": 2, "ג": 3, "ד": 4, "ה": 5, "ו": 6, "ז": 7, "ח": 8, "ט": 9,
    "י": 10, "כ": 20, "ך": 20, "ל": 30, "מ": 40, "ם": 40, "נ": 50, "ן": 50, "ס": 60, "ע": 70, "פ": 80, "ף": 80, "צ": 90, "ץ": 90,
    "ק": 100, "ר": 200, "ש": 300, "ת": 400,
}

# fixed values: final letters and the letters they stand for
FINAL_LETTERS, PLAIN_LETTERS = "ךםןףץ", "כמנפצ"

# fixed values: civil years and their Hebrew names
HEBREW_YEARS = {
    2008: 'תשס"ח', 2009: 'תשס"ט', 2010: 'תש"ע', 2011: 'תשע"א', 2012: 'תשע"ב', 2013: 'תשע"ג', 2014: 'תשע"ד', 2015: 'תשע"ה',
    2016: 'תשע"ו', 2017: 'תשע"ז', 2018: 'תשע"ח', 2019: 'תשע"ט', 2020: 'תש"פ', 2021: 'תשפ"א', 2022: 'תשפ"ב', 2023: 'תשפ"ג',
    2024: 'תשפ"ד', 2025: 'תשפ"ה', 2026: 'תשפ"ו',
}
FIRST_YEAR, LAST_YEAR = 2008, 2026

# fixed values: parts of an id that tell its stage; the first found in this order counts
STAGE_PARTS = [
    ("beitsifri", "school"), ("school", "school"),
    ("mehozi", "district"), ("mehoz", "district"), ("mahoz", "district"), ("district", "district"), ("regional", "district"),
    ("artzi", "national"), ("arzi", "national"), ("national", "national"),
    ("olami", "world"), ("olam", "world"), ("world", "world"), ("internat", "world"),
]

# fixed values: marks of the two tracks in an id; the first group is looked for first
TRACK_MARKS = {
    "mamlachti_dati": ["mamlachti_dati", "mamlachtidati", "mmldati", "mmd", "mamad", "dati", "md"],
    "mamlachti": ["mamlachti", "mamlchti", "mmlchti", "mlchti", "mm"],
}
TRACKS = ["mamlachti", "mamlachti_dati"]
STAGES = ["school", "district", "national", "world"]
ADULT_PARTS = ["adult", "mehozipumbi"]

# fixed values: ids whose facts can't be read from the name (track, stage, year, age group)
ID_OVERRIDES = {
    "PreMm25": ("mamlachti", "national", 2025, None),
    "adults_2020": ("mamlachti", "national", 2020, "adult"),
    "adults_district_quiz33": ("mamlachti", "district", None, "adult"),
    "adults_international_bible_quiz": ("mamlachti", "world", None, "adult"),
    "adults_quiz_2022": ("mamlachti", "world", 2022, "adult"),
    "artziktav2016": ("mamlachti", "national", None, None),
    "internataionaladultswritten2020": ("mamlachti", "world", 2020, "adult"),
    "mehozipumbi2016": ("mamlachti", "district", None, "adult"),
    "pre_adults_district_quiz": ("mamlachti", "district", None, "adult"),
}
KNOWN_UNREADABLE = ["ARTZI_PUB_MM", "OLAMI_PUB_MMD"]

# fixed values: books in their order, with the English names used in references
BOOKS = {
    "בראשית": "Genesis", "שמות": "Exodus", "ויקרא": "Leviticus", "במדבר": "Numbers", "דברים": "Deuteronomy",
    "יהושע": "Joshua", "שופטים": "Judges", "שמואל א": "I Samuel", "שמואל ב": "II Samuel", "מלכים א": "I Kings", "מלכים ב": "II Kings",
    "ישעיהו": "Isaiah", "ירמיהו": "Jeremiah", "יחזקאל": "Ezekiel", "הושע": "Hosea", "יואל": "Joel", "עמוס": "Amos", "עובדיה": "Obadiah",
    "יונה": "Jonah", "מיכה": "Micah", "נחום": "Nahum", "חבקוק": "Habakkuk", "צפניה": "Zephaniah", "חגי": "Haggai", "זכריה": "Zechariah",
    "מלאכי": "Malachi", "תהילים": "Psalms", "תהלים": "Psalms", "משלי": "Proverbs", "איוב": "Job", "שיר השירים": "Song of Songs", "רות": "Ruth",
    "איכה": "Lamentations", "קהלת": "Ecclesiastes", "אסתר": "Esther", "דניאל": "Daniel", "עזרא": "Ezra", "נחמיה": "Nehemiah",
    "דברי הימים א": "I Chronicles", "דברי הימים ב": "II Chronicles",
}
BOOK_ABBREVIATIONS = {
    "שמא": "שמואל א", "שמב": "שמואל ב", "מלא": "מלכים א", "מלב": "מלכים ב", "דהא": "דברי הימים א", "דהב": "דברי הימים ב", "דבה": "דברי הימים א",
}

# fixed values: option keys; the first four are those of a full question
OPTION_KEYS = ["א", "ב", "ג", "ד", "ה"]

# fixed values: phrases that ask who spoke, and openings of questions that a "not" turns around
SPEAKER_PHRASES = ["על מי נאמר", "על מה נאמר", "מי אמר", "למי נאמר", "מי אמרו", "בדברי מי"]
QUESTION_OPENINGS = ["איזה", "אילו", "מה", "מי"]
NOT_WORD = "לא"

# fixed values: marks of answer-key files in ids
ANSWER_MARKS = r"answers?|tshuvon|teshuvon|written_test_ans|_ans\b|\bans\b|^an[_-]"
ANSWER_FILE = r"answers?|_ans|ans_|tshuvon|teshuvon|^an[_-]"
DATI_MARKS = r"mamad|dati|mmd|(^|[_-])md($|[_-]|[0-9])|ממד"

# fixed values: headings of the answer key and of the cover page
ANSWER_KEY_HEADING = "תשובון"
COVER_MINUTES, COVER_SUPERVISOR, COVER_COORDINATOR, COVER_AUTHORS = "זמן הבחינה", 'הממונה על חידוני התנ"ך', "מרכז החידון ועורך החידון", "מחברי? השאלות"

# fixed values: lines of question pages and answer keys (option, question)
OPTION_LINE = r"(?U)^([אבגדה])\.\s*(.*)$"
QUESTION_LINE = r"(?U)^(\d+)\.\s+(.*)$"

# fixed values: lines of the staged booklets
STAGE_LINE = r"(?U)^\s*שלב\s+([אבגד])\b\s*[:\-–]?\s*(.*)$"
DATI_LINE = r"(?U)^\s*(?:[^:]*:\s*)?ממלכתי\s*[-–]\s*דתי\s*:?\s*$"
GENERAL_LINE = r"(?U)^\s*(?:[^:]*:\s*)?ממלכתי\s*:?\s*$"
ANSWERS_LINE = r"(?U)^\s*תשובות\s*:\s*$"
ANSWER_LINE = r"(?U)^\s*ה?תשובה\s*:\s*(.*)$"
CROSSWORD_LINE = r"(?U)^\s*תשבץ\s+(\d+)\s*:\s*$"
PAIR_LINE = r"(?U)^\s*צמד\s+(\d+)\s*:\s*(.*)$"
POEM_LINE = r"(?U)^\s*שאלה\s+(\d+)\s*$"
CLUE_LINE = r"(?U)^\s*(\d+)\.\s*\((מאונך|מאוזן)\)\s*(.*)$"
ITEM_LINE = r"(?U)^\s*(\d+)\.\s*(.*)$"
PART_LINE = r"(?U)^\s*([אבגד])\.\s*(.*)$"
LENGTH_MARK = r"(?U)\(\s*(\d+(?:\s*,\s*\d+)*)\s*\)"
ALSO_ACCEPTED = r"(?U)תתקבל גם(?:\s+התשובה)?\s*:?\s*(.+)"
ALTERNATES_CLAUSE = r"(?U)(?:יתקבל(?:ו)? גם|תתקבל גם(?:\s+התשובה)?)\s*:?\s*(.+)"
BOOK_HINTS = "שמואל|מלכים|דברי הימים|ישעיה|ירמיה"

# fixed values: words and headings of the staged booklets and of answer tables
STAGE_WORD, PAIR_WORD, CROSSWORD_WORD, QUESTION_WORD = "שלב", "צמד", "תשבץ", "שאלה"
LATER_STAGE = r"(?U)שלב\s+[בג]\b"
THE_ANSWER_MARK, ANSWERS_MARK = "התשובה:", "תשובות:"
BOOKLET_STAGES = r"ראש\s+בראש|תשבצים|בעקבות\s+(?:קטעי|סרטונים)|המילה המשותפת|מה הקשר"
SUBTYPES = {"תשבצים": "crossword", "תשבץ": "crossword", "ראש בראש": "head-to-head"}
TRACK_TITLES = {"mamlachti": "ממלכתי", "mamlachti-dati": "ממלכתי-דתי"}
TABLE_HEADING = "מקור|תשובה|באות|במילים"

# fixed values: the regulations' numbers (points for an answer, points a hint costs, seconds)
RULE_POINTS = r"(?U)ב[-־]?\s*(\d+)\s+נקודות"
RULE_HINT = r"(?U)רמז[^.]{0,40}?(\d+)\s+נקודות"
RULE_SECONDS = r"(?U)(\d+)\s+שניות"

# fixed values: code points
POINTS = "\\u0591-\\u05C7"  # points and cantillation
VOWELS = "\\u05B0-\\u05C7"
LETTERS = "\\u05D0-\\u05EA"
LOST = "�"
NAME_SHORT, NAME_FULL = ["ה'", "ה׳", "ה’", "יי"], "יהוה"
EXPECTED_QUESTIONS = 35
TAGS = ["b", "u", "i"]

"""Fixed values of the directory's rules: vocabularies, orders and patterns that results depend on."""

# Enumerations of the tables.
CHARACTER_TYPES = ("human", "ogier", "trolloc", "myrddraal", "horse", "wolf", "other")
FACTION_TYPES = ("ajah", "order", "house", "clan", "society", "other")
ALIAS_TYPES = ("primary", "given_name", "title", "epithet", "nickname", "disguise")
SPECIES = ("trolloc", "myrddraal")

# Forms of address and junk that identify nobody.
GENERIC = (
    "sister", "sisters", "aes sedai", "king", "queen", "the king", "the queen", "lord", "lady", "my lord", "my lady",
    "captain", "eldest", "mother", "child", "daughter", "son", "my son", "the innkeeper",
    "girl", "boy", "lad", "lass", "man", "woman", "wench", "the girl", "the boy", "the lad", "the lass", "the man", "the woman",
    "mistress", "stranger", "the stranger", "fellow", "what", "the",
)
# Single words that are probably no names.
SUSPECT = ("what", "who", "where", "when", "why", "how", "yes", "no", "here", "there", "this", "that", "these", "those", "good", "bad", "old", "young", "the", "and", "but")
# Common words that are names too: a mention by one of them alone proves little.
NOISY = (
    "red", "blue", "green", "brown", "gray", "grey", "white", "black", "gold", "else", "true", "first", "last", "dark", "light",
    "good", "glad", "cold", "warm", "calm", "bold", "wise", "fair", "free", "high", "long", "deep", "far",
)

# Ranks, longest first, and adjectives that make a description of a name.
RANKS = ("lord captain commander", "lord captain", "high lord", "high lady", "aes sedai", "dai shan", "lord", "lady", "master", "mistress", "mother", "sedai", "ser", "dame")
ADJECTIVES = ("stout", "little", "big", "tall", "short", "old", "young", "fat", "thin", "small", "large", "grizzled", "weaselly", "scrawny", "plump", "stocky", "lean", "wiry", "burly", "gaunt", "portly")
MISNOMER = r"(?i)\b(mistak|wrongly|incorrectly|in error|erroneous|corrects?|misname|not (actually|really)|confus)"

# Names that are never placeholders; last words and roles that make one.
ALLOWED = ("the creator", "the dark one", "the green man", "the dragon", "the dragon reborn", "the great lord", "the great lord of the dark", "the eye of the world", "the forsaken", "the wheel", "the pattern", "the true source")
TAILS = ("man", "woman", "boy", "girl", "child", "maid", "groom", "wench", "wife", "husband", "soldier", "guard", "guardsman", "person", "figure", "stranger", "servant", "attendant", "worker", "fellow", "youth", "elder")
ROLES = (
    "stableman", "innkeeper", "groom", "peddler", "farmwife", "farmhand", "serving girl", "serving woman", "serving man", "guardsman", "merchant",
    "farmer", "clerk", "cook", "washerwoman", "herbalist", "seamstress", "blacksmith", "fletcher", "armorer", "gleeman", "wisdom", "mayor",
    "stableboy", "shepherd", "captain", "lieutenant", "general",
)

# Origins: prefixes that say nothing, names of peoples and regions.
UNRESOLVED = ("unknown", "unclear", "unspecified", "n/a", "none", "tbd", "not stated", "not known", "n.a")
DEMONYMS = {
    "andoran": "Andor", "cairhienin": "Cairhien", "tairen": "Tear", "illianer": "Illian", "saldaean": "Saldaea", "arafellin": "Arafel",
    "shienaran": "Shienar", "kandori": "Kandor", "ghealdanin": "Ghealdan", "murandian": "Murandy", "altaran": "Altara", "amadician": "Amadicia",
    "taraboner": "Tarabon", "domani": "Arad Doman", "mayener": "Mayene", "malkieri": "Malkier", "tar valoner": "Tar Valon",
}
PARENTS = {
    "emond's field": "Two Rivers", "watch hill": "Two Rivers", "taren ferry": "Two Rivers", "deven ride": "Two Rivers", "two rivers": "Andor",
    "baerlon": "Andor", "whitebridge": "Andor", "maule": "Tear", "lugard": "Murandy", "tanchico": "Tarabon", "amador": "Amadicia",
    "ebou dar": "Altara", "salidar": "Altara", "fal dara": "Shienar", "fal moran": "Shienar", "cachin": "Kandor", "maradon": "Saldaea",
    "jehanna": "Ghealdan", "caemlyn": "Andor",
}
PEOPLES = {"aiel": "Aiel", "tuatha'an": "Tuatha'an", "tinker": "Tuatha'an", "tinkers": "Tuatha'an", "atha'an miere": "Atha'an Miere", "sea folk": "Atha'an Miere"}
COSMIC = ("the creator", "the dark one", "machin shin", "mashadar")

# Ages: the scale, and the patterns that put a phrase on it; the first that matches counts.
BANDS = ("child", "young", "adult", "middle years", "older", "elderly")
BAND_PATTERNS = (
    ("elderly", r"\b(elderly|ancient|very old|(?<!-)aged|grandmother|grandfather|white[- ]haired|wizened|pensioner|dotage|great[- ]grand)\b"),
    ("middle years", r"\b(middle[- ]aged|middle years|middle-years|midlife|mid-life|mature|prime|thirties|forties|fifties|30s|40s|50s|veteran|well beyond thirty|past thirty)\b"),
    ("older", r"\b(old|older|aging|ageing|gray|grey|graying|greying|silver|balding|senior|elder|lined face|matron)\b"),
    ("young", r"\b(young|youngish|younger|youngest|youth|youthful|teen|teenage|adolescent|novice|apprentice|youngster|lad|lass|twenties|20s|barely grown|of majority)\b"),
    ("child", r"\b(child|infant|baby|babe|toddler|boy|girl|little)\b"),
    ("adult", r"\b(adult|grown|man|woman|fully grown)\b"),
)
NO_AGE = r"^(alive|living|deceased|dead|unknown|n/?a|none|unclear|unspecified|not stated|immortal)\b"
DURATION = r"\b(years? ago|years? (before|since|earlier|later|as)|thousand|hundred|centur|ages? ago|times?|seasons?)\b"
COMPARATIVE = (
    r"(\([^)]*\bthan\b[^)]*\)|[^,;(]*\b(older|younger|elder|senior|junior)\b[^,;()]*\bthan\b[^,;()]*|\bold enough\b[^,;()]*"
    r"|\b\w+\s+times\b[^,;()]*age[^,;()]*|\bof an age with\b[^,;()]*|\bsame age as\b[^,;()]*|\bnear\b[^,;()]*\bage\b)"
)
UNITS = {
    "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10, "eleven": 11, "twelve": 12,
    "thirteen": 13, "fourteen": 14, "fifteen": 15, "sixteen": 16, "seventeen": 17, "eighteen": 18, "nineteen": 19,
}
TENS = {"twenty": 20, "thirty": 30, "forty": 40, "fifty": 50, "sixty": 60, "seventy": 70, "eighty": 80, "ninety": 90}

# Matching: words that set nobody apart, thresholds, particles of names.
STOPWORDS = ("the", "a", "an", "of", "and", "my", "son", "daughter", "mother", "father", "lord", "lady", "sir", "master", "mistress", "captain", "high", "lady's", "lord's", "aes", "sedai")
FUZZY, POINTER, NEAR = 0.86, 0.6, 0.88
PARTICLES = ("do", "a", "ni", "t", "si", "din", "al", "of", "son", "the")
PROTECTED, DROPPABLE = ("primary", "given_name", "disguise"), ("title", "epithet", "nickname")
GUARDED_TRAITS, GUARDED_FACTIONS = ("physical_traits", "age", "personality"), ("other", "order")

# Roles inside groups, marks of local paths, group types by rank, colours.
GROUP_ROLES = ("sister", "brother")
PATH_MARKS = ("C:\\", "/home/", "/Users/", "OneDrive", "books/", "books\\")
PRIORITY = ("ajah", "house", "order", "clan", "society", "other")
PALETTE = ("#6e2230", "#3f7a4f", "#3f5f7a", "#9a7b3f", "#a8517a", "#b5702a", "#6a6a55", "#4a6071", "#7a3f5f", "#5a7a3f", "#7a5a3f", "#3f7a7a")
NO_COLOUR = "#8a8170"

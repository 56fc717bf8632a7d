"""Lexicons of the analysis domain (RNA interference): data that operators are given, not logic."""

from __future__ import annotations

# Terms of the block queries.
BLOCK_TERMS = [
    "siRNA*",
    "RNAi*",
    "dsRNA*",
    "si-RNA*",
    "ds-RNA*",
    "iRNA*",
    '"RNA interference"',
    '"RNA-interference"',
    '"interfering RNA"',
    '"small interfering RNA"',
    '"small interfering RNAs"',
    '"short interfering RNA"',
    '"short interfering RNAs"',
    '"small-interfering RNA"',
    '"short-interfering RNA"',
    '"double-stranded RNA"',
    '"double stranded RNA"',
    '"double-stranded RNAs"',
    '"double stranded RNAs"',
    '"RNA duplex"',
    '"RNA duplexes"',
    '"small interfering ribonucleic acid"',
    '"small-interfering ribonucleic acid"',
    '"short interfering ribonucleic acid"',
    '"short-interfering ribonucleic acid"',
    '"double-stranded ribonucleic acid"',
    '"double stranded ribonucleic acid"',
    '"ribonucleic acid interference"',
    '"interfering ribonucleic acid"',
    '"small interfering ribonucleic acids"',
    '"small-interfering ribonucleic acids"',
    '"short interfering ribonucleic acids"',
    '"short-interfering ribonucleic acids"',
    '"double-stranded ribonucleic acids"',
    '"double stranded ribonucleic acids"',
    '"interfering ribonucleic acids"',
]
BLOCK_CODES = ("C12N15/113", "A61K31/713")
# Terms, codes and exclusions of the independent queries.
SINGLE_TERMS = [
    "siRNA*",
    "RNAi*",
    "dsRNA*",
    "iRNA*",
    "dsRNAi*",
    "oligonucleotide*",
    '"si-RNA"',
    '"ds RNA"',
    '"RNA interference"',
    '"interfering RNA"',
    '"small interfering RNA"',
    '"small interfering RNAs"',
    '"short interfering RNAs"',
    '"short interfering RNA"',
    '"double stranded RNA"',
    '"double stranded RNAs"',
    '"RNA duplex"',
    '"RNA duplexes"',
    '"small interfering ribonucleic acid"',
    '"small interfering ribonucleic acids"',
    '"short interfering ribonucleic acid"',
    '"short interfering ribonucleic acids"',
    '"double stranded ribonucleic acid"',
    '"double stranded ribonucleic acids"',
    '"ribonucleic acid interference"',
    '"interfering ribonucleic acid"',
    '"interfering ribonucleic acids"',
]
SINGLE_LOW_CODES = ("C12N15/11", "A61K31/7088")
SINGLE_IPC_CODES = ("C12N15/113", "A61K31/713", "C12N15/11", "A61K31/7088")
EXCLUDED_CODES = ("C12N15/115", "C12N15/117")
# Title terms, matched anywhere in a word.
COMPETITOR = "CRISPR|Cas9|Cas13|antisense|ASO|microRNA|miRNA|circRNA|circular RNA|aptamer"
AGRI_TITLE = "plant|crop|seed|weed|agriculture|botanical|maize|corn|soybean|wheat|herbicide|pesticide|veterinary|canine|bovine|porcine"
# The class code that anchors a record.
ANCHOR = "C12N15/113"
# Text signals of the classification; T marks a closing word border.
SIGNAL = (
    r"\bsiRNA\b", r"\bsi-RNA\b", r"\bRNAi\b", r"\bdsRNA\b", r"\bdsRNAi\b", r"\bds-RNA\b", r"\bRISC\b", r"\bDicer\b",
    r"small\s+interfering\s+RNA", r"short\s+interfering\s+RNA", r"RNA\s+interference", r"RNA[\s-]induced\s+silenc", r"double[\s-]stranded\s+RNA",
    r"double[\s-]stranded\s+ribonucleic", r"small\s+interfering\s+ribonucleic", r"short\s+interfering\s+ribonucleic", r"ribonucleic\s+acid\s+interference",
    r"interfering\s+ribonucleic", r"\bRNA\s+duplex\b", r"RNAi\s+(?:agent|molecule|therapeuti|oligonucleotide)", r"siRNA\s+(?:agent|molecule|therapeuti|delivery|construct)",
    r"gene\s+silenc\w+", r"RNA\s+silenc\w+", r"post.transcriptional\s+silenc", r"sequence.specific\s+silenc",
)
FORBIDDEN = (
    "CRISPR", "Cas9", "Cas12", "Cas13", "antisense", r"ASO\s*(?:therapy|treatment|oligonucleotide)\b", "microRNA", "miRNA", r"miR-\d+", "circRNA", r"circular\s+RNA",
    "aptamer", r"mRNA\s+vacc", r"mRNA\s+therap",
)
DIAGNOSTIC = ("biomarker", r"prognostic\s+marker", r"diagnostic\s+kit", r"detection\s+method", r"assay\s+kit", r"sequencing\s+method", r"ELISA\s+kit")
TREATMENT = ("treat", "therap", "drug", "medicine", "medicament")
AGRI = (
    "crop", "weed", "maize", "corn(?!ea)", "soybean", "wheat", "barley", "tobacco", r"tomato(?!\s+cell)", "potato", "cotton", "canola", "rapeseed", "sugarcane",
    "Arabidopsis", "thaliana", "herbicide", "pesticide", "insecticide", "fungicide", "nematicide", "nematode", "aphid", "whitefly", "thrips", "locust", "livestock",
    "poultry", "swine", "porcine", "ovine", "equine", "caprine", "cattle", r"sheep(?!\s+cell)", "goat", "turkey", "aquaculture", "Fusarium", "Botrytis", "Phytophthora",
    "Pythium", r"powdery\s+mildew", "Agrobacterium", "biopesticide", r"pest\s+control", "biocontrol", r"filamentous\s+fung", r"yeast\s+strain", r"fungal\s+strain",
    "Aspergillus", "Trichoderma", "Neurospora", r"Pichia\s+pastoris", r"Saccharomyces\s+cerevisiae", r"C\.\s*elegans", "Caenorhabditis", r"Drosophila\s+melanogaster",
    r"Xenopus\s+laevis", r"insect\s+cell(?!s?\s+line)", r"Sf9\s+cell", r"baculovirus\s+express",
)
# Tier labels in order.
TIERS = (
    "TIER 1 — siRNA Confirmed (Text + CPC)", "TIER 2 — siRNA Confirmed (Text only)", "TIER 3 — siRNA by CPC only (Check Abstract)",
    "TIER 4A — Mixed Tech (siRNA + Forbidden Term)", "TIER 4B — Diagnostic/Biomarker only (Review)", "TIER 5 — Agri/Vet with siRNA CPC (Review)",
    "TIER 6 — No siRNA Signal (Likely Irrelevant)", "TIER 7 — Agri/Vet without siRNA (Likely Irrelevant)",
)
UNCLASSIFIED = "UNCLASSIFIED"
# The sentinels of missing texts.
NO_ABSTRACT = "No abstract available in EPO database"
NO_TITLE = "No title"
# Words of a legal form, deleted wherever they stand in a name.
LEGAL_WORDS = "INC|INCORPORATED|CORP|CORPORATION|L L C|LLC|LTD|LIMITED|CO|COMPANY|GMBH|SA|PLC|NV|A/S|AG|PTY|PTE|AND"
# Persons that aren't organisations, found anywhere in a normalised name.
PERSONS = [
    "IWAMOTO NAOKI",
    "LIU WEI",
    "LUU KHOA",
    "MARAPPAN",
    "VARGEESE",
    "OWEN ADRIANA",
    "YANG HSIU",
    "LAMATTINA",
    "BYRNE",
    "SINGH KULDEEP",
    "SHAH HIMALI",
    "KAWAMOTO",
    "GHOSH",
    "HAEGELE",
    "HU YANBIN",
    "HE HUIJUN",
    "LU JIANYU",
    "HE HAIYING",
    "CHEN SHUHUI",
    "GLEBOCKA",
    "KLOSSOWSKI",
    "SHUVAEV",
    "DESAI JIGAR",
    "PRAKASHA PRIYANKA",
    "LONGO KENNETH",
    "DESAI",
    "LONGO",
    "PRAKASHA",
    "PEI TAO",
    "BLOKHIN ANDREI",
    "CHEN JING",
    "ENDEAN THOMAS",
    "BENSON JONATHAN",
    "KANDASAMY",
    "LU GENLIANG",
    "KUMARASAMY",
    "CHATTERJEE",
]
# Parts of a normalised name and the organisation they stand for; the first that is found decides.
ORGANISATIONS = [
    ("WISCONSIN", "MEDICAL COLLEGE OF WISCONSIN"),
    ("MASSACHUSETTS", "UNIVERSITY OF MASSACHUSETTS"),
    ("BRITISH COLUMBIA", "UNIVERSITY OF BRITISH COLUMBIA"),
    ("PEKING", "PEKING UNIVERSITY"),
    ("BEIJING", "PEKING UNIVERSITY"),
    ("ANTWERP", "UNIVERSITY OF ANTWERP"),
    ("LIEGE", "UNIVERSITY OF LIEGE"),
    ("VIRGINIA", "UNIVERSITY OF VIRGINIA"),
    ("TEXAS", "UNIVERSITY OF TEXAS"),
    ("TORONTO", "UNIVERSITY OF TORONTO"),
    ("CALIFORNIA", "UNIVERSITY OF CALIFORNIA"),
    ("FLORIDA", "UNIVERSITY OF FLORIDA"),
    ("JOHNS HOPKINS", "JOHNS HOPKINS UNIVERSITY"),
    ("TOKYO MEDICAL", "TOKYO MEDICAL UNIVERSITY"),
    ("KOBE", "KOBE UNIVERSITY"),
    ("DALIAN MINZU", "DALIAN MINZU UNIVERSITY"),
    ("XUZHOU", "XUZHOU MEDICAL UNIVERSITY"),
    ("DANA FARBER", "DANA FARBER CANCER INSTITUTE"),
    ("KOREA INST", "KOREA INSTITUTE OF SCIENCE AND TECHNOLOGY"),
    ("SUNGKYUNKWAN", "SUNGKYUNKWAN UNIVERSITY"),
    ("DELAWARE", "DELAWARE STATE UNIVERSITY"),
    ("DELFT", "DELFT UNIVERSITY OF TECHNOLOGY"),
    ("ULSAN", "ULSAN NATIONAL INSTITUTE OF SCIENCE AND TECHNOLOGY"),
    ("TOKAI", "TOKAI NATIONAL HIGHER EDUCATION AND RESEARCH SYSTEM"),
    ("UNIVERSITY NANTONG", "NANTONG UNIVERSITY"),
    ("UNIVERSITY NORTHWESTERN POLYTECHNICAL", "NORTHWESTERN POLYTECHNICAL UNIVERSITY"),
    ("UNIVERSITY XIAMEN", "XIAMEN UNIVERSITY"),
    ("UNIVERSITY HEBEI TECHNOLOGY", "HEBEI UNIVERSITY OF TECHNOLOGY"),
    ("UNIVERSITY EAST CHINA NORMAL", "EAST CHINA NORMAL UNIVERSITY"),
    ("UNIVERSITY NANJING AGRICULTURAL", "NANJING AGRICULTURAL UNIVERSITY"),
    ("UNIVERSITY SOUTH CHINA AGRICULT", "SOUTH CHINA AGRICULTURAL UNIVERSITY"),
    ("UNIVERSITY KYOTO", "KYOTO UNIVERSITY"),
    ("CARDIOLOGIE DE MONTREAL", "MONTREAL HEART INSTITUTE"),
    ("NATIONWIDE CHILDREN", "NATIONWIDE CHILDRENS HOSPITAL"),
    ("CHILDRENS MEDICAL", "CHILDRENS HOSPITAL MEDICAL CENTER"),
    ("CHILDRENS HOSPITAL MED", "CHILDRENS HOSPITAL MEDICAL CENTER"),
    ("GENOME RES", "GENOME RESEARCH"),
    ("CMS RES", "CMS RESEARCH & DEVELOPMENT"),
    ("LILLY", "ELI LILLY"),
    ("EXORNA", "EXORNA BIOSCIENCE"),
    ("RONA", "RONA THERAPEUTICS"),
    ("BISIRNA", "BISIRNA THERAPEUTICS"),
    ("JENKEM", "JENKEM TECHNOLOGY"),
    ("QILU", "QILU PHARMACEUTICAL"),
    ("ANSHUN", "SHANDONG ANSHUN PHARMACEUTICAL"),
    ("CHIA TAI", "CHIA TAI TIANQING PHARMACEUTICAL GROUP"),
    ("ALNYLAM", "ALNYLAM PHARMACEUTICALS"),
    ("ARROWHEAD", "ARROWHEAD PHARMACEUTICALS"),
    ("SUZHOU RIBO", "SUZHOU RIBO LIFE SCIENCE"),
    ("RIBO LIFE SCIENCE", "SUZHOU RIBO LIFE SCIENCE"),
    ("DYNE", "DYNE THERAPEUTICS"),
    ("TUOJIE", "TUOJIE BIOTECH SHANGHAI"),
    ("BEBETTER", "BEBETTER MED"),
    ("YINGTE", "YINGTE MED TECH"),
    ("TAKEDA", "TAKEDA PHARMACEUTICALS"),
    ("JANSSEN", "JANSSEN PHARMACEUTICALS"),
    ("MPEG LA", "MPEG LA"),
    ("SRINA", "SIRNA THERAPEUTICS"),
    ("SIRNA THERAPEUTICS", "SIRNA THERAPEUTICS"),
    ("REGENERON", "REGENERON PHARMACEUTICALS"),
    ("HANSOH", "HANSOH PHARMACEUTICAL"),
    ("NOVO NORDISK", "NOVO NORDISK"),
    ("OLIX", "OLIX PHARMACEUTICALS"),
    ("FRANCAISE CONTRE LES MYOPATHIES", "ASSOCIATION FRANCAISE CONTRE LES MYOPATHIES"),
    ("HUMANWELL", "HUMANWELL HEALTHCARE GROUP"),
]

"""Fixed values. Results depend on them literally, so they are stated as they are."""

# --- fixed values: noise patterns, name -> regular expression ---------------
PATTERNS = {
    "mentions": r"@\w+",
    "hashtags": r"#\w+",
    "html_tags": r"<.*?>",
    "urls": r"http\S+",
    "contractions": r"\w+'\w+",
    "non_letters": r"[^a-zA-Z\s]",
}

# --- fixed values: contraction rules, applied in this order -----------------
CONTRACTIONS = [
    ("won't", "will not"),
    ("can't", "cannot"),
    ("n't", " not"),
    ("'re", " are"),
    ("'s", " is"),
    ("'d", " would"),
    ("'ll", " will"),
    ("'ve", " have"),
    ("'m", " am"),
]

# --- fixed values: the earlier, shorter contraction list --------------------
CONTRACTIONS_SHORT = [("n't", " not"), ("'s", " is")]

# --- fixed values: typo -> correction ---------------------------------------
TYPOS = {
    "diabetis": "diabetes",
    "insülin": "insulin",
    "medicacion": "medication",
    "hosptial": "hospital",
    "admision": "admission",
    "especialidad": "specialty",
}

# --- fixed values: stop-words added to Spark's English list -----------------
EXTRA_STOP_WORDS = ["v", "e", "a", "s"]

# --- fixed values: missing markers and their replacement --------------------
MISSING = "?"
UNKNOWN = "Unknown"

# --- fixed values: drug and category values that give no token --------------
INACTIVE_DRUG = ["No", "None", "nan"]
EMPTY_CATEGORY = ["", "Unknown", "None"]

# --- fixed values: noisy sample text ----------------------------------------
NOISY_KEY = 110939484
NOISY_TEXT = (
    "@dr_smith Hi! Check pt 110939484 — clearly has diabetis. Don't trust the lab; "
    "she can't tolerate hosptial admision today. Going to bump her insülin therapy. "
    "#diabetes #insulin Refs: <b>see chart</b> at https://example-hospital.org/chart "
    "(she's a 70-yr-old, won't comply, hasn't taken medicacion in 3 days)."
)

# --- fixed values: quality gate on the silhouette ---------------------------
SILHOUETTE_TARGET = 0.6

# --- fixed values: cluster names by threshold, in test order ----------------
LEVEL_NAMES = {
    "recurrent": "Pacientes Recurrentes / Alta Carga Asistencial",
    "evaluation": "Pacientes en Evaluación Intensiva / Casos Complejos",
    "drug": "Pacientes con Tratamiento Farmacológico Intensificado",
    "followup": "Pacientes en Seguimiento Diagnóstico / Comorbilidad Controlada",
    "adjusted": "Pacientes con Ajuste Farmacológico Reciente",
    "low": "Pacientes de Baja Utilización / Episodio Único",
}

# --- fixed values: cluster names by score, three groups ---------------------
SCORE_NAMES = {
    "recurrent": "Pacientes recurrentes / alta carga farmacológica",
    "complex": "Pacientes en evaluación intensiva / casos complejos",
    "routine": "Pacientes ambulatorios / control rutinario",
}

# --- fixed values: cluster names by score, any number of groups -------------
OPEN_NAMES = {
    "recurrent": "Pacientes Recurrentes / Alta Carga Asistencial",
    "complex": "Pacientes en Evaluación Intensiva / Casos Complejos",
    "routine": "Pacientes Ambulatorios / Control Rutinario",
    "mixed": "Perfil Mixto / Subgrupo ",
}

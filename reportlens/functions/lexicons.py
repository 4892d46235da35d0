"""Word lists, weights and category maps.

These lists define the results (a term is matched as a substring of the
lower-cased text, so their spelling, blanks and order matter). They are plain
data; every function that uses them takes another list as an argument.
"""

from __future__ import annotations

# --- stop words ----------------------------------------------------------

EN_STOP = (
    "the a an of and or to is are was were be in on at for with from by as it "
    "its this that these those not no"
).split()

FR_STOP = (
    "le la les un une des de du au aux et ou ni mais a à dans en sur sous par "
    "pour avec sans ce cet cette ces son sa ses notre nos votre vos je tu il "
    "elle on nous vous ils elles me te se est sont ont a était que qui quoi "
    "dont plus moins très bien aussi non oui d l n s y t"
).split()

FR_STOP_PROFILE = (
    "le la les un une des de du au aux et ou ni mais a à dans en sur sous par "
    "pour avec sans ce cet cette ces son sa ses notre nos votre vos je tu il "
    "elle on nous vous ils elles me te se est sont etre être ont a avait "
    "avaient suis es que qui quoi dont plus moins très tres bien aussi non oui "
    "d l n s y t"
).split()


def stop_words(lang: str):
    return {"en": EN_STOP, "fr": FR_STOP, "fr_profile": FR_STOP_PROFILE}.get(lang, [])


# --- category maps (first match wins, so the order is part of the value) ---

EN_CATEGORIES = {
    "Normal": ["normal"],
    "Cardiomegaly": ["cardiomegaly"],
    "Opacity/Mass": ["opacity", "mass", "nodule", "lesion"],
    "Atelectasis": ["atelectasis"],
    "Pleural Effusion": ["pleural effusion", "effusion"],
    "Pneumonia": ["pneumonia", "consolidation", "infiltrate", "airspace disease"],
    "Emphysema/COPD": ["emphysema", "copd", "chronic obstructive", "hyperdistention"],
    "Edema": ["edema", "congestion"],
    "Fracture": ["fracture"],
    "Pneumothorax": ["pneumothorax"],
}

EN_LABEL_CATEGORIES = {
    **EN_CATEGORIES,
    "Emphysema/COPD": [
        "emphysema", "copd", "pulmonary disease, chronic obstructive", "hyperdistention",
    ],
    "Edema": ["edema", "pulmonary congestion", "congestion"],
    "Degenerative": ["degenerative", "spondylosis"],
    "Atherosclerosis": ["atherosclerosis", "calcinos"],
    "Granuloma": ["granuloma"],
    "Hernia": ["hernia"],
    "Fibrosis": ["fibrosis", "scarring"],
}

MAIN_LABELS = [
    "Normal", "Cardiomegaly", "Opacity/Mass", "Atelectasis",
    "Pleural Effusion", "Pneumonia", "Emphysema/COPD", "Edema",
]

MAIN_CLASSES = ["Normal", "Cardiomegaly", "Opacity/Mass", "Pneumonia", "Pleural Effusion"]

FR_CATEGORIES = {
    "Normal": ["normal", "aspect normal"],
    "Cardiomegaly": ["cardiomégalie", "index cardio-thoracique"],
    "Mass": ["masse", "nodule", "lésion"],
    "PleuralEffusion": ["épanchement", "pleural"],
    "Pneumonia": ["pneumonie", "condensation", "foyer infectieux"],
    "Pneumothorax": ["pneumothorax"],
}

FR_CONDITIONS = ["Cardiomegaly", "Mass", "PleuralEffusion", "Pneumonia", "Pneumothorax"]

FR_KEY_TERMS = [
    "cardiomégalie", "pneumonie", "épanchement", "pneumothorax", "masse",
    "opacité", "condensation", "nodule", "consolidation", "médiastinal",
    "pleural", "normal",
]

# --- feature lexicons ------------------------------------------------------

EN = {
    "name": "en",
    "lang": "en",
    "positive": [
        "normal", "unremarkable", "clear", "stable", "no change",
        "within normal", "no evidence", "no acute", "no significant",
    ],
    "negative": [
        "abnormal", "consolidation", "opacity", "effusion", "mass", "nodule",
        "cardiomegaly", "edema", "pneumothorax", "fracture", "worsening",
        "enlarged", "increased", "infiltrate", "collapse",
    ],
    "entities": [
        "lung", "heart", "cardiac", "mediastin", "pleural", "aort", "spine",
        "rib", "diaphragm", "hilum", "bronch", "trachea", "pulmonary",
        "thoracic", "sternum", "clavicle", "pericard",
    ],
    "severity": {
        "mild": 1, "minimal": 1, "slight": 1, "small": 1, "trace": 1,
        "moderate": 2, "partial": 2,
        "severe": 3, "significant": 3, "large": 3, "marked": 3, "extensive": 3,
        "massive": 4, "critical": 4,
    },
    "diagnostic": [
        "diagnosis", "consistent with", "suggestive of", "compatible with",
        "likely", "probable", "suspect", "concerning for", "indicative of",
        "represent", "confirmed", "evidence of",
    ],
    "hedges": [
        "possibly", "probably", "may", "might", "could", "suggest", "appear",
        "likely", "cannot exclude", "cannot rule out", "questionable", "uncertain",
    ],
    "temporal": [
        "prior", "previous", "interval", "since", "new", "old", "chronic",
        "acute", "progressive", "stable", "unchanged", "worsening", "improving",
    ],
    "recommendations": [
        "recommend", "suggest", "follow-up", "followup", "correlation",
        "clinical correlation", "further evaluation", "ct scan", "additional",
    ],
    "negations": [
        "no ", "not ", "without ", "absent", "unremarkable", "negative",
        "denies", "no evidence", "none", "neither",
    ],
    "abbreviations": [
        "AP", "PA", "CT", "CXR", "ICU", "COPD", "CHF", "ETT", "NG", "RLL",
        "LLL", "RUL", "LUL", "RML", "CABG", "DJD", "ICD", "IV",
    ],
    "passive": ["is ", "are ", "was ", "were ", "been ", "being "],
    "vowels": "aeiouy",
    "categories": EN_CATEGORIES,
    "comorbidity": {
        "heart failure": 2, "congestive": 2, "chf": 2, "hypertension": 1,
        "diabetes": 2, "renal": 2, "liver": 2, "obesity": 1, "cancer": 3,
        "malignant": 3, "copd": 2, "emphysema": 2, "asthma": 1,
    },
    "charlson": {
        "myocardial infarction": 1, "heart failure": 1, "peripheral vascular": 1,
        "cerebrovascular": 1, "pulmonary disease": 1, "copd": 1, "diabetes": 1,
        "renal disease": 2, "malignant": 2, "metastatic": 6,
    },
    "passive_min_words": 1,
}

EN_EXTENDED = {
    **EN,
    "name": "en_extended",
    "positive": EN["positive"] + ["resolved", "improved"],
    "severity": {**EN["severity"], "complete": 4},
    # "CT scan" is kept in upper case: it never matches lower-cased text.
    "recommendations": [
        "recommend", "suggest", "follow-up", "followup", "correlation",
        "clinical correlation", "further evaluation", "CT scan", "additional",
    ],
    "comorbidity": {
        **EN["comorbidity"], "arthritis": 1, "anemia": 1, "coagulopathy": 2,
        "depression": 1, "hypothyroid": 1,
    },
    "charlson": {
        **EN["charlson"], "dementia": 1, "connective tissue": 1,
        "peptic ulcer": 1, "liver disease": 1, "hemiplegia": 2, "aids": 6,
        "leukemia": 2, "lymphoma": 2,
    },
    "passive_min_words": 3,
    "strip_text": True,
}

FR = {
    "name": "fr",
    "lang": "fr",
    "positive": ["normal", "absence", "pas d'", "sans", "aspect normal", "inchangé", "stable"],
    "negative": [
        "opacité", "condensation", "épanchement", "masse", "nodule",
        "cardiomégalie", "œdème", "pneumothorax", "fracture", "augmentation",
        "élargissement", "infiltrat", "atteinte", "pneumonie",
    ],
    "entities": [
        "poumon", "cœur", "cardiaque", "médiastin", "pleural", "aorte",
        "rachis", "côte", "diaphragm", "hil", "bronch", "trachée",
        "pulmonaire", "thoracique", "sternum", "clavicule", "péricard",
    ],
    "severity": {
        "discrète": 1, "minime": 1, "légère": 1, "petite": 1,
        "modérée": 2, "moyenne": 2, "partielle": 2,
        "sévère": 3, "important": 3, "large": 3, "marquée": 3, "étendue": 3,
        "massive": 4, "severe": 3,
    },
    "diagnostic": [
        "compatible avec", "évocateur de", "évoque", "en faveur de",
        "probable", "suggérer", "aspect de", "pouvant correspondre",
    ],
    "hedges": [
        "possible", "probable", "peut", "pourrait", "semble", "apparaît",
        "douteux", "questionnable",
    ],
    "temporal": [
        "antérieur", "précédent", "depuis", "nouveau", "ancien", "chronique",
        "aigu", "évolutif", "stable", "inchangé",
    ],
    "recommendations": [
        "recommand", "suggér", "à recontrôler", "corrélation clinique",
        "compléter par", "évaluation complémentaire", "scanner",
    ],
    "negations": ["absence d'", "absence de", "pas de", "pas d", "sans", "aucun", "aucune"],
    "abbreviations": [
        "CT", "IRM", "TDM", "OAP", "BPCO", "AVC", "AVP", "ICT", "PA", "AP", "CXR",
    ],
    "passive": ["est ", "sont ", "était ", "été "],
    "vowels": "aeiouyàâäéèêëîïôöùûüœæ",
    "categories": FR_CATEGORIES,
    "passive_min_words": 1,
    "default_age": 50.0,
}

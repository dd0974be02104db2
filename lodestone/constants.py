"""Names, thresholds and presets that results depend on."""

# The conditions a classifier scores, display spelling.
CONDITIONS = [
    "Atelectasis",
    "Cardiomegaly",
    "Consolidation",
    "Edema",
    "Effusion",
    "Emphysema",
    "Fibrosis",
    "Hernia",
    "Infiltration",
    "Mass",
    "Nodule",
    "Pleural Thickening",
    "Pneumonia",
    "Pneumothorax",
]

# Search terms added to a query for a condition.
CONDITION_CONTEXT = {
    "Atelectasis": "atelectasis lung collapse volume loss chest radiograph management",
    "Cardiomegaly": "cardiomegaly enlarged heart cardiothoracic ratio heart failure echocardiography",
    "Consolidation": "pulmonary consolidation lobar pneumonia air bronchograms chest X-ray",
    "Edema": "pulmonary edema fluid overload heart failure diuretics chest radiograph",
    "Effusion": "pleural effusion thoracentesis Light criteria transudative exudative",
    "Emphysema": "emphysema COPD hyperinflation bullae pulmonary function",
    "Fibrosis": "pulmonary fibrosis interstitial lung disease honeycombing HRCT restrictive",
    "Hernia": "diaphragmatic hernia hiatal hernia chest radiograph surgical repair",
    "Infiltration": "pulmonary infiltrate differential diagnosis infection inflammation chest imaging",
    "Mass": "pulmonary mass lung cancer solitary nodule malignancy biopsy staging",
    "Nodule": "pulmonary nodule lung cancer screening calcification malignancy risk Fleischner",
    "Pleural Thickening": "pleural thickening asbestos mesothelioma chronic pleuritis imaging",
    "Pneumonia": "pneumonia community-acquired empiric antibiotics CURB-65 chest radiograph treatment",
    "Pneumothorax": "pneumothorax chest tube tension pneumothorax management visceral pleural line",
    "Normal": "normal chest radiograph anatomy cardiac silhouette costophrenic angles",
}

NO_FINDING = "No Finding"

# Text splitters, sizes in characters.
RECURSIVE_SEPARATORS = ["\n\n", "\n", ". ", " "]
SENTENCE_SEPARATORS = [". ", "! ", "? ", "\n"]
CHUNKING_STRATEGIES = {
    "recursive_800": {"kind": "recursive", "size": 800, "overlap": 80, "separators": RECURSIVE_SEPARATORS},
    "recursive_paragraph": {"kind": "recursive", "size": 450, "overlap": 50, "separators": RECURSIVE_SEPARATORS},
    "sentence_based": {"kind": "recursive", "size": 200, "overlap": 30, "separators": SENTENCE_SEPARATORS},
    "natural_paragraph": {
        "kind": "natural",
        "whole_up_to": 1000,
        "size": 900,
        "overlap": 90,
        "separators": RECURSIVE_SEPARATORS,
    },
    "fixed_512": {"kind": "words", "size": 512},
    "fixed_256": {"kind": "words", "size": 256},
    "document": {"kind": "document"},
}
SWEEP_SIZES = [600, 800, 1000, 1200]

# Validity and relevance limits.
MIN_ABSTRACT_CHARS = 50
MIN_QUERY_CHARS = 5
TOPIC_COVERED_ABOVE = 0.45
NOISE_BELOW = 0.30
DEFAULT_THRESHOLD = 0.5
MIN_CONFIDENCE = 0.15
AUC_GOOD = 0.80
AUC_FAIR = 0.70
LOG_RESPONSE_CHARS = 2000

# Retrieval presets.
SERVED_PRESET = {"strategy": "recursive_paragraph", "k": 7, "mode": "vector"}
HYBRID_PRESET = {
    "strategy": "recursive_800",
    "mode": "hybrid",
    "depth": 40,
    "k": 7,
    "bm25_weight": 2.0,
    "vector_weight": 1.0,
    "rrf_k": 60,
    "floor": 0.30,
}
EXACT_FUSION = {"depth": 20, "k": 5, "rrf_k": 60}
K_SWEEP = [3, 5, 7, 10, 15]
FLOOR_SWEEP = [None, 0.20, 0.30, 0.35, 0.40, 0.45]
BM25_WEIGHT_SWEEP = [0.5, 1.0, 1.5, 2.0, 3.0]

# Threshold search grid, 100 evenly spaced points.
THRESHOLD_GRID = (0.05, 0.95, 100)
SPLIT_SHARES = (0.8, 0.1)
SPLIT_SEED = 42

"""Word lists and lookup tables that results depend on.

Fixed values: they must be as they are for equal results; the order within each list matters for ties.
"""

STOP_WORDS = [
    "the", "a", "an", "is", "are", "was", "were", "be", "been", "have", "has", "had", "do", "does", "did", "will", "would",
    "could", "should", "may", "might", "can", "this", "that", "these", "those", "it", "its", "and", "or", "but", "if",
    "then", "else", "when", "where", "how", "what", "why", "이", "그", "저", "것", "수", "등", "및", "또는", "의", "를", "을",
]

DOMAINS = {
    "programming": ["python", "javascript", "typescript", "java", "rust", "go", "code", "function", "class", "api", "library", "framework", "코드", "함수", "프로그래밍", "개발"],
    "machine-learning": ["model", "training", "neural", "deep learning", "ai", "ml", "embedding", "transformer", "bert", "gpt", "llm", "모델", "학습", "인공지능", "딥러닝", "임베딩"],
    "data-science": ["data", "pandas", "numpy", "analysis", "visualization", "데이터", "분석", "시각화", "통계"],
    "devops": ["docker", "kubernetes", "ci/cd", "deploy", "container", "aws", "azure", "gcp", "cloud", "배포", "컨테이너", "클라우드"],
    "web": ["html", "css", "react", "vue", "angular", "frontend", "backend", "웹", "프론트엔드", "백엔드"],
    "database": ["sql", "nosql", "postgresql", "mongodb", "redis", "데이터베이스", "쿼리"],
}

#: Function words that vote for a language.
LANGUAGE_WORDS = {
    "de": ["der", "die", "das", "und", "nicht", "ist", "ein", "eine"],
    "en": ["the", "and", "of", "to", "is", "in", "that", "for"],
    "es": ["el", "los", "que", "y", "una", "por", "con", "del"],
    "fr": ["le", "les", "et", "des", "une", "est", "que", "dans"],
    "nl": ["het", "een", "en", "van", "niet", "op", "voor", "zijn"],
    "pt": ["o", "os", "e", "uma", "que", "não", "com", "do"],
}

#: Embedding dimensions of known models; others count as DEFAULT_DIMENSION.
MODEL_DIMENSIONS = {
    "BAAI/bge-m3": 1024,
    "intfloat/multilingual-e5-large": 1024,
    "intfloat/multilingual-e5-base": 768,
    "sentence-transformers/all-MiniLM-L6-v2": 384,
    "sentence-transformers/all-mpnet-base-v2": 768,
}
DEFAULT_DIMENSION = 1024

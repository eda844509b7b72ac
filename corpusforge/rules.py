"""Options of a run: domain words, filters and size limits.

Nothing domain-specific is hard-coded in the operators; they read it from a
``DomainRules`` value.  The defaults below are the generic part.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# They decide the results, so they are stated literally.
# ---------------------------------------------------------------------------

# A page is skipped when its URL path contains one of these.
SKIPPED_URL_PARTS = ("/api/", "/changelog", "/search", "/_", ".xml", ".json", "/tags/")

# Page class by the first matching part of the lower-cased URL path.
PAGE_CLASSES = (
    ("tutorial", ("/develop", "/sdk")),
    ("reference", ("/references", "/api")),
    ("concept", ("/encyclopedia", "/glossary")),
    ("guide", ("/production", "/deploy")),
)
DEFAULT_PAGE_CLASS = "documentation"

# A repository file is skipped when a parent folder has one of these names.
SKIPPED_FOLDERS = ("node_modules", "vendor", ".git", "__pycache__", "dist", "build")

# File suffixes that are collected.
KEPT_EXTENSIONS = (".py", ".ts", ".js", ".go", ".java", ".md", ".mdx")

# Language by file suffix.
LANGUAGES = {
    ".py": "python",
    ".ts": "typescript",
    ".js": "javascript",
    ".go": "go",
    ".java": "java",
    ".md": "markdown",
    ".mdx": "markdown",
    ".yaml": "yaml",
    ".yml": "yaml",
    ".json": "json",
}

# Display name of a language inside questions; others keep their raw name.
LANGUAGE_NAMES = {
    "python": "Python",
    "typescript": "TypeScript",
    "go": "Go",
    "java": "Java",
}

# Content types that may carry a code answer, and the one with headings.
CODE_TYPES = ("example", "code", "implementation")
HEADING_TYPE = "documentation"

# Headings that are too generic to become a question.
GENERIC_HEADINGS = ("overview", "introduction", "summary", "table of contents")

# A heading starting with one of these only gets a question mark appended.
QUESTION_STARTS = ("how", "what", "why", "when")

# Question wordings for a concept; {concept} and {domain} are slots.
CONCEPT_QUESTIONS = (
    "What is a {concept} in {domain}?",
    "Explain the concept of {concept} in {domain}.",
    "How does {concept} work in {domain}?",
    "What is the purpose of {concept} in {domain}?",
)
HEADING_QUESTION = "What is {heading} in {domain}?"
CODE_QUESTION = "How do I implement a {concept} in {domain} using {language}?"
CODE_ANSWER = "Here's an example of implementing a {concept} in {language}:\n\n```{tag}\n{code}\n```"

# Marks appended to shortened texts.
ANSWER_MARK = "..."
CODE_MARK = "\n# ... (truncated)"

UNTITLED = "Untitled"

SITEMAP_NAMESPACE = "http://www.sitemaps.org/schemas/sitemap/0.9"

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Limits:
    """Sizes in code points and counts per document.

    The least sizes are filters.  The others cut texts and lists only where they are given; without them
    whole texts are read and every concept, section and hit counts.
    """

    min_content: int = 100
    min_paragraph: int = 100
    min_section: int = 100
    max_content: int | None = None
    max_answer: int | None = None
    max_code: int | None = None
    max_prompt: int | None = None
    concepts_per_document: int | None = None
    sections_per_document: int | None = None
    searched_concepts: int | None = None
    hits_per_concept: int | None = None
    train_fraction: float = 0.9


@dataclass(frozen=True)
class DomainRules:
    """What a corpus is about.  ``vocabulary`` order is significant."""

    domain: str
    vocabulary: tuple[str, ...]
    system_prompt: str = ""
    prompt_subject: str = ""
    docs_source: str = "docs"
    docs_base_url: str = ""
    docs_host_pattern: str = r"https://[^/<]+"
    title_suffix: str = ""
    priority_paths: tuple[str, ...] = ()
    repositories: tuple[str, ...] = ()
    # Without a repository the search covers those of this owner; all without an owner.
    search_owner: str = ""
    relevance_patterns: tuple[str, ...] = ()
    relevance_path_words: tuple[str, ...] = ()
    skipped_url_parts: tuple[str, ...] = SKIPPED_URL_PARTS
    skipped_folders: tuple[str, ...] = SKIPPED_FOLDERS
    kept_extensions: tuple[str, ...] = KEPT_EXTENSIONS
    # Parts of a lower-cased file path that mark an implementation.
    implementation_words: tuple[str, ...] = ()
    # "hyphenated": the words of a term may be joined by a blank, a hyphen or
    # nothing.  "literal": a several-word term only matches the text of its own
    # pattern, e.g. "task[ -]?queue".
    multiword: str = "hyphenated"

    def __post_init__(self):
        if self.multiword not in ("hyphenated", "literal"):
            raise ValueError(f"multiword must be 'hyphenated' or 'literal', not {self.multiword!r}")
        for term in self.vocabulary:
            if not term.strip():
                raise ValueError("empty vocabulary term")

    @property
    def subject(self) -> str:
        """Longer name of the domain, for prompts."""
        return self.prompt_subject or self.domain

"""quireflow: page layouts to reading-ordered Markdown, as Spark DataFrame operators."""

__version__ = "0.1.0"

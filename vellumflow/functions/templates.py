"""Fixed texts and the column functions that fill them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Results are compared byte for byte, white space included.
TABLE_TEXT = "\n                Captions:{captions}\n\n                Content:{text}\n            "
PICTURE_TEXT = "\n                Captions:{captions}\n\n                Text:{text}\n            "
PAGE_TEXT = "Headings:{headings}\nPage Description:{text}"
BODY_TEXT = (
    "\n            Headings:{headings}\n\n            Captions:{captions}\n\n            Text:{text}\n        "
)
PASSAGE = "Passage: {chunk_text}\n Document URI: {document_uri}\n"
IMAGE_REQUEST = "Describe the contents of this {image_type}. Keep the response within {max_tokens} words"
NO_PAGES = "No pages in document"
CARD = "\nSource: {filename}\nType: {chunk_type}\nID: {id}\n\nContent:\n{page_content}\n"
CARD_RULE = "\n\n---\n\n"
REWRITTEN = (
    "To incorporate context from our conversation, I've rewritten your question as:\n\n"
    "        '{question}'\n        "
)
CHAT_SYSTEM = "Answer the following question preceded by So, yeah."
CONTEXT_SYSTEM = (
    "You are a trusted assistant that helps answer questions based only on the provided context. "
    "Here is some context which might or might not help you answer: {context}.  If the context is not "
    "helpful, you should say you do not know, and summarize the context in one sentence."
)
REPHRASE_SYSTEM = (
    "Based on conversation history below, rephrase the user's last question to capture context from the "
    "prior conversation that is necessary to answer the user's last question. The refrased question will "
    "be used to perform a semantic similarity search to find documents relevent to the user's last "
    "question. Do not answer the question. Simply return the refrased question without any explanation"
)
IMAGE_TYPES = ["page", "table", "picture"]


def fill(template: str, **values: Column) -> Column:
    """Concatenate the literal parts of ``template`` with columns; null counts as empty."""
    parts: list[Column] = []
    rest = template
    while rest:
        head, brace, tail = rest.partition("{")
        if head:
            parts.append(F.lit(head))
        if not brace:
            break
        name, _, rest = tail.partition("}")
        parts.append(F.coalesce(values[name].cast("string"), F.lit("")))
    return F.concat(*parts)


def listed(values: Column) -> Column:
    return F.coalesce(F.array_join(values, ", "), F.lit(""))


def image_request(image_type: Column, max_tokens: Column) -> Column:
    """Request text for a description; any other image type is an error."""
    text = fill(IMAGE_REQUEST, image_type=image_type, max_tokens=max_tokens)
    return F.when(image_type.isin(IMAGE_TYPES), text).otherwise(
        F.raise_error(F.concat(F.lit("not a describable image type: "), F.coalesce(image_type, F.lit("null"))))
    )

from pageloom.functions import text, tokens, urls

__all__ = ["text", "tokens", "urls"]

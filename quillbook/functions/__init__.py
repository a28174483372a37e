from quillbook.functions import codes, groups, identity, rules

__all__ = ["codes", "groups", "identity", "rules"]

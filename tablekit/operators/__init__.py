from . import aggregate, joins, keyed, ordering, sampling, sets, shaping

__all__ = ["aggregate", "joins", "keyed", "ordering", "sampling", "sets", "shaping"]

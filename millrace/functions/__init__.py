from millrace.functions.money import cents, total_of, wide
from millrace.functions.names import standard_name, standard_names

__all__ = ["cents", "standard_name", "standard_names", "total_of", "wide"]

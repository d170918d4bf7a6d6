"""Type maps, checked casts and date predicates: everything returns a type or a Column."""

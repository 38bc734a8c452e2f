"""Column functions: native expressions first, Arrow UDFs where SQL can't express the semantics."""

"""Column expressions shared by the operators. No UDFs: every one stays inside codegen."""

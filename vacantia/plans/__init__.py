"""Jobs built from the operators: conforming, star schema, marts, skills, matching, salary model."""

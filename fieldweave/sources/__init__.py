"""Views that give the stored tables the shapes of the operators."""

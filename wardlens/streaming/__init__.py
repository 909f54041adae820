"""Rules that run the same on stored rows and on arriving ones."""

"""Default word lists. Every operator takes its list as a parameter."""

# Spanish stopwords.
STOPWORDS = frozenset("""
de la el en y a los las un una
es se no con por que del al lo su
para como más pero sus le ya o fue
este ha si porque esta son entre cuando
muy sin sobre también me hasta hay donde
quien desde todo nos durante uno ni contra
""".split())

# Political keywords, plain spelling.
KEYWORDS = tuple("""
petro uribe duque gobierno presidente
politica elecciones votar
congreso senado reforma corrupcion
estado ley ministro
""".split())

# Political keywords, accented and plain spelling.
KEYWORDS_ACCENTED = tuple("""
petro uribe duque gobierno presidente
política politica elecciones votar
congreso senado reforma corrupción
corrupcion estado ley ministro
""".split())

# Positive words.
POSITIVE = frozenset("""
bien bueno buena excelente positivo positiva
éxito logro avance progreso esperanza mejor
desarrollo beneficio apoyo favor correcto justo
paz acuerdo solución oportunidad crecimiento
inversión empleo salud educación seguridad
victoria triunfo alegría libre libertad
democracia transparencia honesto
reforma cambio transformación mejora mejoría
recuperación estabilidad confianza credibilidad
diálogo negociación concertación reconciliación
inclusión equidad justicia derechos garantías
protección bienestar prosperidad fortalecimiento
modernización innovación competitividad productividad
subsidio beneficio ayuda apoyo respaldo
reconocimiento premio destacado exitoso efectivo
""".split())

# Negative words.
NEGATIVE = frozenset("""
malo mala mal terrible pésimo negativo
fracaso problema crisis corrupción corrupto
robo mentira fraude violencia guerra conflicto
pobreza desempleo inflación escándalo injusto
ilegal criminal crimen impunidad dictadura
represión desastre caos peor desigualdad
hambre miseria muerte asesinato secuestro
denuncia denuncias acusación acusaciones acusado
investigado investigación cuestionado polémico polémica
irregularidad irregularidades fallo demanda demandas
protesta protestas huelga bloqueo bloqueos
escasez desabastecimiento deuda déficit impuesto
sanciones sanción destitución destituido suspendido
capturado detenido preso condenado sentenciado
corruptos ladrones roban robando malversación
clientelismo nepotismo burocracia ineficiencia
abandono abandonado olvidado excluido marginalizado
desplazado refugiado víctima víctimas afectado
deterioro empeoró empeorar decayó retroceso
incumplimiento incumplió promesa mentiras engaño
manipulación manipulado censurado censura
polarización división enfrentamiento choque
inestabilidad incertidumbre riesgo amenaza peligro
""".split())
